"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

#: Usable vectors as integers.
GRID = """
  SELECT vec_id, label, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

OP11_SQL = f"""
WITH d AS ({GRID}),
s AS (
  SELECT q.vec_id AS query_id, q.r AS qr, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
  FROM d q JOIN d ON q.r <> d.r WHERE q.vec_id % 50 = 0
),
o AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM o WHERE place <= 5
"""


def _tree(name: str, levels: int) -> list[str]:
    """CTEs ``{name}0 .. {name}levels`` of trees with columns tree, i, n, h, and each node's siblings."""
    out = []
    for k in range(levels):
        run = "PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN"
        out.append(
            f"{name}{k}s AS (SELECT tree, i, n, h, CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS lft, "
            f"CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS rgt FROM {name}{k})"
        )
        out.append(
            f"{name}{k + 1} AS (SELECT tree, i // 3 AS i, CAST(ceil(n / 3.0) AS BIGINT) AS n, "
            f"CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h FROM {name}{k} GROUP BY tree, i // 3, n)"
        )
    return out


def op12_sql(levels: int = 12, tree_levels: int = 7) -> str:
    """Trees of up to 3^levels documents a source and 3^tree_levels sources, level by level."""
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    byte = "list_reduce(list_value(xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))"  # the CRC's reflected polynomial
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))), lambda c, b: {byte}), 4294967295)"
    ctes = [
        f"d AS (SELECT doc_id, coalesce('s' || source, 'n') AS tree, sha256({head} || {part('text')}) AS h, "
        f"sha256({head} || {part('t')}) AS received FROM (SELECT *, CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t FROM documents))",
        "l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM d)",
        "a0 AS (SELECT tree, i, n, h FROM l)",
        *_tree("a", levels),
        f"b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n, h, tree AS name FROM a{levels})",
        *_tree("b", tree_levels),
        "f AS (SELECT l.*, b0.i AS bi, b0.n AS bn, b0.h AS subroot FROM l JOIN b0 ON b0.name = l.tree)",
    ]
    fold, proof, joins = "f.received", [], []
    for name, depth, i, n in (("a", levels, "f.i", "f.n"), ("b", tree_levels, "f.bi", "f.bn")):
        for k in range(depth):
            s = f"{name}{k}s"
            on = "f.tree" if name == "a" else "''"
            joins.append(f"JOIN {s} ON {s}.tree = {on} AND {s}.i = {i} // {3**k}")
            proof.append(f"{s}.lft || {s}.rgt")
    steps, prior = [], "p0"
    columns = ", ".join(f"{s}.lft AS {s}_l, {s}.rgt AS {s}_r, {s}.n AS {s}_n" for s in [f"a{k}s" for k in range(levels)] + [f"b{k}s" for k in range(tree_levels)])
    steps.append(f"p0 AS (SELECT f.doc_id, f.h AS leaf, f.subroot, {' || '.join(proof)} AS siblings, {fold} AS x, {columns} FROM f {' '.join(joins)})")
    for j, s in enumerate([f"a{k}s" for k in range(levels)] + [f"b{k}s" for k in range(tree_levels)]):
        steps.append(f"p{j + 1} AS (SELECT * REPLACE (CASE WHEN {s}_n > 1 THEN sha256({s}_l || x || {s}_r) ELSE x END AS x) FROM {prior})")
        prior = f"p{j + 1}"
    return (
        f"WITH {', '.join(ctes + steps)} SELECT p.doc_id, p.leaf, p.subroot, r.h AS root, sha256(p.siblings) AS proof_sha256, p.x AS folded_root, p.x = r.h AS verified "
        f"FROM {prior} p, b{tree_levels} r"
    )


def op13_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    ctes = [
        f"d AS MATERIALIZED ({GRID})",
        f"p AS MATERIALIZED (SELECT r, vec_id, part, v[part * w + 1 : part * w + w] AS x FROM (SELECT r, vec_id, v, len(v) // {parts} AS w FROM d), range({parts}) t(part))",
        f"first AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM d ORDER BY vec_id LIMIT {entries})",
        "c0 AS MATERIALIZED (SELECT part, entry, x AS c FROM p JOIN first USING (r))",
    ]
    for k in range(rounds + 1):
        ctes.append(
            f"n{k} AS MATERIALIZED (SELECT r, part, any_value(x) AS x, min(e) AS e, min(entry) FILTER (WHERE e = least_e) AS entry FROM (SELECT *, min(e) OVER (PARTITION BY r, part) AS least_e FROM "
            f"(SELECT r, p.part, x, entry, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS e FROM p JOIN c{k} c ON p.part = c.part)) GROUP BY r, part)"
        )
        if k < rounds:
            ctes.append(
                f"m{k} AS (SELECT part, entry, list(CAST(floor((s - ((s % n) + n) % n) / n) AS DOUBLE) ORDER BY j) AS c FROM "
                f"(SELECT part, entry, j, CAST(sum(x[j]) AS BIGINT) AS s, count(*) AS n FROM n{k}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS j) GROUP BY part, entry, j) GROUP BY part, entry)"
            )
            ctes.append(f"c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN m{k} m ON m.part = c.part AND m.entry = c.entry)")
    ctes += [
        f"o AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(e) AS BIGINT) AS error FROM n{rounds} GROUP BY r)",
        f"b AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: CAST(y AS BIGINT)), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})",
    ]
    return (
        f"WITH {', '.join(ctes)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM d JOIN o USING (r), b"
    )
