"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WS = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"'[^\x20\x09-\x0D]+'"

LINE_DEDUP = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
held AS (
  SELECT doc_id, i AS pos, parts[i] AS line, translate(trim(parts[i], {_WS}), '{_UP}', '{_LOW}') AS k
  FROM docs, unnest(range(1, len(parts) + 1)) AS u(i)),
often AS (SELECT k, max(doc_id) AS keeper FROM held WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT h.*, coalesce(h.doc_id <> o.keeper, false) AS lost FROM held h LEFT JOIN often o USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _seats(name: str, parties: str, by: str, order: str, weight: str, total: str) -> str:
    """Highest quotients, written out: every party's quotients up to its share and a few more, ranked."""
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, {order}" if by else order
    return f"""
{name}_all AS (SELECT *, sum({weight}) OVER ({part}) AS w_, count(*) OVER ({part}) AS n_ FROM {parties}),
{name}_won AS (
  SELECT {keys}, count(*) AS seats FROM (
    SELECT {keys}, {total} AS total_, row_number() OVER ({part} ORDER BY {weight}::DOUBLE / (2 * k - 1) DESC, {order}, k) AS rank_
    FROM {name}_all, unnest(range(1, 3 + cast(floor({weight} * ({total} + n_) / w_) AS BIGINT))) AS u(k) WHERE {weight} > 0) AS q
  WHERE rank_ <= total_ GROUP BY {keys}),
{name} AS (SELECT p.*, coalesce(w.seats, 0) AS seats FROM {parties} p LEFT JOIN {name}_won w USING ({keys}))"""


def mixing(table: str = "documents", block: int = 128, shard: int = 1_000_000, seed: int = 17) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS size,
    md5('{seed}:' || coalesce(cast(doc_id AS VARCHAR), 'null')) AS h FROM {table}),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS r, sum(source_size) OVER () * 1.5::DOUBLE AS every FROM s0),
s2 AS (SELECT *, source_size * 2.0::DOUBLE AS cap, [5.0::DOUBLE, 2.0, 1.0][((r - 1) % 3 + 1)::INT] AS weight FROM s1),
s3 AS (SELECT *, (every - coalesce(sum(cap) OVER (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s2),
s4 AS (SELECT source, source_size, r, least(cap, weight * max(level) OVER ()) AS target, round(every / {block})::BIGINT AS blocks,
  greatest(ceil(source_size / {shard}), 1) AS shards FROM s3),
s5 AS (SELECT *, ceil(sqrt(shards))::BIGINT AS bundles, ceil(shards / ceil(sqrt(shards)))::BIGINT AS parts FROM s4),
{_seats("s6", "s5", "", "r", "target", "blocks")},
p AS (SELECT d.doc_id, d.size, d.h, s6.r, s6.source_size, s6.target, s6.seats AS quota,
    ('0x' || substr(h, 1, 15))::BIGINT % bundles AS bundle, (('0x' || substr(h, 1, 15))::BIGINT // bundles) % parts AS shard
  FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source),
b0 AS (SELECT r, bundle, sum(size)::BIGINT AS bundle_words, any_value(quota) AS quota FROM p GROUP BY r, bundle),
{_seats("b1", "b0", "r", "bundle", "bundle_words", "quota")},
h0 AS (SELECT p.r, p.bundle, p.shard, sum(p.size)::BIGINT AS shard_words, any_value(b1.seats) AS quota
  FROM p JOIN b1 ON p.r = b1.r AND p.bundle = b1.bundle GROUP BY p.r, p.bundle, p.shard),
{_seats("h1", "h0", "r, bundle", "shard", "shard_words", "quota")},
x AS (SELECT p.*, h1.shard_words AS w, least(h1.seats * {block}, 2 * h1.shard_words) AS length,
    sum(p.size) OVER (PARTITION BY p.r, p.bundle, p.shard ORDER BY p.h, p.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until,
    ('0x' || substr(md5('{seed}:shard:' || p.r || ':' || p.bundle || ':' || p.shard), 1, 15))::BIGINT % greatest(h1.shard_words, 1) AS at_
  FROM p JOIN h1 ON p.r = h1.r AND p.bundle = h1.bundle AND p.shard = h1.shard),
y AS (SELECT *, until - size AS since, length // greatest(w, 1) AS turns, length % greatest(w, 1) AS rest FROM x)
SELECT doc_id, size, source_size, target, (turns * size + greatest(0, least(until, at_ + rest, w) - greatest(since, at_))
  + greatest(0, least(until, at_ + rest - w) - since))::BIGINT AS taken FROM y
"""


MIXING = mixing()

QUALITY_RULES = f"""
WITH d AS (SELECT row_number() OVER () AS row_, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, {_WORD}) AS words,
  list_filter(string_split(text, chr(10)), lambda x: trim(x, {_WS}) <> '') AS parts FROM d),
rep AS (
  SELECT row_, count(DISTINCT p) AS n FROM (
    SELECT row_, unnest([i, i + 1, i + 2]) AS p FROM (
      SELECT row_, g.i AS i, count(*) OVER (PARTITION BY row_, g.t) AS c FROM (
        SELECT row_, unnest(list_transform(range(1, len(words) - 1), lambda i: {{'i': i, 't': words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]}})) AS g
        FROM w) AS a) AS t WHERE c > 1) AS q GROUP BY row_),
held AS (SELECT row_, source, translate(trim(line, {_WS}), '{_UP}123456789', '{_LOW}000000000') AS k, len(regexp_extract_all(line, {_WORD})) AS n
  FROM (SELECT row_, source, unnest(parts) AS line FROM w) AS l),
hosts AS (SELECT source, count(*) AS n FROM d GROUP BY source),
often AS (SELECT c.source, c.k FROM (SELECT source, k, count(DISTINCT row_) AS docs FROM held GROUP BY source, k) c
  JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source WHERE docs > 100 AND docs > 0.01::DOUBLE * h.n),
lost AS (SELECT row_, sum(held.n) AS words, count(*) AS lines FROM held JOIN often o ON held.k = o.k AND held.source IS NOT DISTINCT FROM o.source GROUP BY row_),
r AS (SELECT w.doc_id, len(w.words) AS n_words, length(translate(text, {_WS}, '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, len(parts) - len(list_distinct(parts)) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost.lines, 0) AS n_removed_lines, len(w.words) - coalesce(lost.words, 0)::BIGINT AS n_left
  FROM w LEFT JOIN rep USING (row_) LEFT JOIN lost USING (row_))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_left >= 0.3::DOUBLE * n_words AS kept FROM r
"""


EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(translate(coalesce(text, ''), {_WS}, '')) AS text_sha256 FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS place,
  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT r.doc_id, w.doc_id AS keep_id, r.group_size, r.place = 1 AS kept, r.text_sha256
FROM r JOIN r AS w ON r.text_sha256 = w.text_sha256 AND w.place = 1
"""

_FINE = "embedding IS NOT NULL AND list_bool_and([coalesce(isfinite(x), false) FOR x IN embedding]) IS NOT false"

HARD_NEGATIVES = f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS comps
  FROM embeddings WHERE label IS NOT NULL AND {_FINE}),
flat AS (SELECT vec_id, label, i, comps[i] AS c FROM kept, unnest(range(1, len(comps) + 1)) AS u(i)),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id AS id, r.label, sum(a.c * r.c)::BIGINT AS score
  FROM flat a JOIN flat r USING (i) WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id GROUP BY ALL),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM scores WHERE label = anchor_label)
  WHERE place <= 5),
windows AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND n.label <> n.anchor_label
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 10
"""


def vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Every round of the codebooks written out: distances, nearest entries, means."""
    def nearest(step: int) -> str:
        return f"""
d{step} AS (SELECT f.vec_id, f.part, b.entry, sum((f.c - b.c) * (f.c - b.c))::BIGINT AS error FROM flat f JOIN b{step} b USING (part, pos) GROUP BY ALL),
n{step} AS (SELECT vec_id, part, arg_min(entry, error * {entries} + entry) AS entry, min(error) AS error FROM d{step} GROUP BY ALL)"""

    moved = ",".join(f"""{nearest(r)},
m{r} AS (SELECT part, entry, pos, sum(c)::BIGINT AS total, count(*) AS n FROM n{r} JOIN flat USING (vec_id, part) GROUP BY ALL),
b{r + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce(CASE WHEN m.total < 0 THEN -((n - 1 - m.total) // n) ELSE m.total // n END, b.c) AS c
  FROM b{r} b LEFT JOIN m{r} m USING (part, entry, pos))""" for r in range(rounds))
    return f"""
WITH kept AS (
  SELECT vec_id, label, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS comps, row_number() OVER (ORDER BY vec_id) - 1 AS place
  FROM embeddings WHERE {_FINE}),
flat AS MATERIALIZED (
  SELECT vec_id, place, (i - 1) // (len(comps) // {parts}) AS part, (i - 1) % (len(comps) // {parts}) AS pos, comps[i] AS c
  FROM kept, unnest(range(1, len(comps) + 1)) AS u(i)),
b0 AS (SELECT part, place AS entry, pos, c FROM flat WHERE place < {entries}),{moved},{nearest(rounds)},
books AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds}),
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(error)::BIGINT AS error FROM n{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), books
"""
