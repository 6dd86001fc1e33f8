"""SQL twins of the corpus queries that SQL can express, by the plain definition."""

#: Quotients target / (2k - 1) are listed one by one; there are more than any claimant can win.
OP3_MIXING = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-' || coalesce(doc_id::VARCHAR, 'null')) AS place
  FROM documents),
weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS number,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
capped AS (
  SELECT *, source_size * 3 AS cap, source_size * 3 / weight AS binds,
         (SELECT sum(source_size) FROM weighed)::BIGINT AS total FROM weighed),
levels AS (
  SELECT c.binds, (any_value(c.total) - coalesce(sum(o.cap) FILTER (o.binds < c.binds), 0))
         / sum(o.weight) FILTER (o.binds >= c.binds) AS level
  FROM capped c, capped o GROUP BY c.binds),
targets AS (
  SELECT source, source_size, number, total, greatest(1, least(8, total // 65536)) AS block,
         greatest(64, (total + 499999) // 500000) AS shards,
         coalesce(least(cap::DOUBLE, weight * (
           SELECT arg_min(level, binds) FROM levels WHERE level <= binds)), 0)::DOUBLE AS target
  FROM capped),
source_seats AS (
  SELECT number, count(*) AS quota FROM (
    SELECT number, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, number) AS place
    FROM (SELECT number, target, unnest(range(1, 3 + 2 * (target // block)::BIGINT
            + (SELECT count(*) FROM targets))) AS k FROM targets WHERE target > 0))
  WHERE place <= (SELECT max(total // block) FROM targets) GROUP BY number),
dealt AS (
  SELECT s.*, t.number, ('0x' || substr(place, 1, 8))::BIGINT % t.shards AS shard
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
cells AS (
  SELECT number, shard, sum(size)::BIGINT AS cell_size FROM dealt GROUP BY number, shard),
shares AS (
  SELECT c.*, coalesce(q.quota, 0) AS seats,
         sum(cell_size) OVER (PARTITION BY number) AS votes,
         count(*) OVER (PARTITION BY number) AS claimants
  FROM cells c LEFT JOIN source_seats q USING (number)),
cell_seats AS (
  SELECT number, shard, count(*) AS quota FROM (
    SELECT number, shard, seats, row_number() OVER (
             PARTITION BY number ORDER BY cell_size / (2 * k - 1) DESC, shard) AS place
    FROM (SELECT *, unnest(range(1, (3 + 2 * (cell_size * seats // votes)
            + claimants)::BIGINT)) AS k FROM shares WHERE cell_size > 0))
  WHERE place <= seats GROUP BY number, shard),
words AS (
  SELECT c.number, c.shard, cell_size, t.source_size, t.target,
         least(coalesce(q.quota, 0) * t.block, cell_size * 3) AS words
  FROM cells c JOIN targets t USING (number) LEFT JOIN cell_seats q USING (number, shard)),
laid AS (
  SELECT d.doc_id, d.size, w.*, sum(d.size) OVER (
           PARTITION BY d.number, d.shard ORDER BY d.place, d.doc_id, d.size
           ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM dealt d JOIN words w USING (number, shard))
SELECT doc_id, size, source_size, target,
       CASE WHEN cell_size = 0 THEN 0 ELSE (words // cell_size) * size
         + greatest(0, least(size, words % cell_size - before)) END::BIGINT AS taken
FROM laid
"""

OP5_LINES = r"""
WITH pages AS (SELECT DISTINCT source, text FROM documents WHERE length(text) > 0),
totals AS (SELECT source, count(*) AS host_pages FROM pages GROUP BY source),
lines AS (
  SELECT DISTINCT source, text,
         trim(regexp_replace(unnest(string_split(text, chr(10))), '[\r\t]', ' ', 'g'), ' ') AS line
  FROM pages),
counts AS (
  SELECT source, line, count(*) AS pages FROM lines WHERE line <> '' GROUP BY source, line),
dropped AS (
  SELECT c.source, list(c.line) AS gone
  FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.pages >= 5 AND c.pages > 0.1::DOUBLE * t.host_pages GROUP BY c.source),
cut AS (
  SELECT d.doc_id, d.text, string_split(coalesce(d.text, ''), chr(10)) AS whole,
         list_filter(string_split(coalesce(d.text, ''), chr(10)), lambda x: NOT list_contains(
           coalesce(g.gone, []), trim(regexp_replace(x, '[\r\t]', ' ', 'g'), ' '))) AS kept
  FROM documents d LEFT JOIN dropped g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CASE WHEN len(kept) < len(whole)
         THEN coalesce(array_to_string(kept, chr(10)), '') ELSE text END AS text,
       CASE WHEN length(text) > 0 THEN len(whole) ELSE 0 END::BIGINT AS n_lines,
       (len(whole) - len(kept))::BIGINT AS n_dropped
FROM cut
"""


def op13_manifest(levels: int = 6) -> str:
    """Trees of up to 16 ** `levels` leaves, every level a table of its own."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))

    def leaf(text: str) -> str:
        fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
        return "sha256(" + " || ".join(
            f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"

    # Bit by bit: a step of the checksum for each bit of each digit.
    step = ("list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: "
            "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)")
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda a, b: {step}), 4294967295)"

    def climb(name: str) -> list[str]:
        """Levels and siblings over `name`0 (tree, pos, hash, members)."""
        made = []
        for k in range(levels):
            span = "OVER (PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN"
            made.append(f"""
{name}_beside{k} AS MATERIALIZED (
  SELECT tree, pos, coalesce(string_agg(hash, '') {span} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(hash, '') {span} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} WHERE members > 1)""")
            made.append(f"""
{name}{k + 1} AS MATERIALIZED (
  SELECT tree, pos // 16 AS pos, CASE WHEN any_value(members) = 1 THEN any_value(hash)
         ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash,
         (any_value(members) + 15) // 16 AS members
  FROM {name}{k} GROUP BY tree, pos // 16)""")
        return made

    def walk(source: str, target: str, name: str, tree: str, pos: str) -> list[str]:
        """Siblings from `name` added to the proof and folded in, level by level."""
        made = []
        for k in range(levels):
            made.append(f"""
{target}{k + 1} AS (
  SELECT w.* REPLACE (proof || coalesce(s.l || s.r, '') AS proof,
         CASE WHEN s.l IS NULL THEN folded ELSE sha256(s.l || folded || s.r) END AS folded)
  FROM {source if k == 0 else f'{target}{k}'} w
  LEFT JOIN {name}_beside{k} s ON s.tree = {tree} AND s.pos = {pos} // {16 ** k})""")
        return made

    parts = [f"""
leafed AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND text IS NOT NULL AND {crc} % 5 = 0
              THEN {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} END AS changed
  FROM documents),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS members FROM leafed),
doc0 AS (SELECT tree, pos, leaf AS hash, members FROM numbered)""",
             *climb("doc"), f"""
subroots AS MATERIALIZED (
  SELECT tree AS name, hash, row_number() OVER (ORDER BY tree) - 1 AS place FROM doc{levels}),
top0 AS (SELECT '' AS tree, place AS pos, hash, count(*) OVER () AS members FROM subroots)""",
             *climb("top"), """
start AS (SELECT *, '' AS proof, coalesce(changed, leaf) AS folded FROM numbered)""",
             *walk("start", "own", "doc", "w.tree", "w.pos"), f"""
placed AS (
  SELECT w.*, s.place, s.hash AS subroot FROM own{levels} w JOIN subroots s ON s.name = w.tree)""",
             *walk("placed", "all_", "top", "''", "w.place")]
    return (f"WITH {','.join(parts)}\n"
            "SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, "
            "folded AS folded_root, folded = root AS verified\n"
            f"FROM all_{levels}, (SELECT hash AS root FROM top{levels})")


def op12_centroids(clusters: int = 8, rounds: int = 10) -> str:
    """Every round as tables of its own: nearest centroid, then means."""
    parts = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR) NULLS LAST, q) - 1 AS c, q
  FROM kept QUALIFY c < {clusters})"""]
    for k in range(rounds + 1):
        parts.append(f"""
a{k} AS MATERIALIZED (
  SELECT n, any_value(vec_id) AS vec_id, any_value(q) AS q, min(d) AS d, arg_min(c, (d, c)) AS c
  FROM (SELECT n, vec_id, kept.q, c,
               list_sum(list_transform(list_zip(kept.q, m.q),
                        lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM kept, c{k} m) GROUP BY n)""")
        if k < rounds:
            parts.append(f"""
s{k} AS MATERIALIZED (
  SELECT c, i, sum(q[i])::BIGINT AS s, count(*) AS m
  FROM a{k}, (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i),
c{k + 1} AS MATERIALIZED (
  SELECT c, coalesce(f.q, old.q) AS q FROM c{k} old LEFT JOIN (
    SELECT c, list(s // m - CASE WHEN s < 0 AND s % m <> 0 THEN 1 ELSE 0 END ORDER BY i) AS q
    FROM s{k} GROUP BY c) f USING (c))""")
    return f"""WITH {','.join(parts)}
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(m.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} m ON m.c = a.c"""
