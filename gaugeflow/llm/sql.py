"""The equivalent SQL of the operators that SQL can state."""

from __future__ import annotations

from gaugeflow.llm.merkle import FAN, FIELDS, TAMPERED
from gaugeflow.llm.url_cascade import RULES

#: Levels written out for a tree: 16 million leaves a source and as many sources.
LEVELS = 6


def _op7() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
),
parts AS (
  SELECT page_id, r, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
numbered AS (SELECT row_number() OVER () AS n, page_id, coalesce(host, '') AS host, coalesce(path, '') AS path FROM parts),
fitting AS (
  SELECT n, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM numbered JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM numbered LEFT JOIN (SELECT * FROM fitting WHERE place = 1) USING (n)
"""


def _tree(name: str, source: str) -> str:
    """CTEs ``{name}0`` (tree, i, n, digest) of ``source`` and up: what is left and right of each node in its run."""
    parts = [f"{name}0 AS ({source})"]
    for k in range(LEVELS):
        run = f"PARTITION BY tree, i // {FAN} ORDER BY i"
        parts.append(
            f"""{name}_at{k} AS (SELECT tree, i, n,
  coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k})"""
        )
        above = f"CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE min(digest) END"
        parts.append(
            f"{name}{k + 1} AS (SELECT tree, i // {FAN} AS i, (n + {FAN - 1}) // {FAN} AS n, {above} AS digest"
            f" FROM {name}{k} GROUP BY tree, i // {FAN}, n)"
        )
    return ",\n".join(parts)


def _op12() -> str:
    def leaf(text: str) -> str:
        values = [f"CAST({text if c == 'text' else c} AS VARCHAR)" for c in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    entry = f"list_reduce(range(8), lambda c, x: {step}, i)"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x))"
    crc = f"xor(list_reduce({digits}, lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
    joins, proof, folded = "", [], "coalesce(claimed, leaf)"
    for name, place in (("d", "i"), ("s", "tree")):
        for k in range(LEVELS):
            at = f"{name}{k}x"
            joins += f"\nJOIN {name}_at{k} {at} ON {at}.i = ranked.{place} // {FAN**k}"
            joins += f" AND {at}.tree = ranked.tree" if name == "d" else ""
            proof.append(f"CASE WHEN {at}.n > 1 THEN {at}.l || {at}.r ELSE '' END")
    steps = [f"{name}{k}x" for name in "ds" for k in range(LEVELS)]
    folds = "".join(
        f",\nf{j + 1} AS (SELECT *, CASE WHEN n_{j} > 1 THEN sha256(l_{j} || own_{j} || r_{j}) ELSE own_{j} END AS own_{j + 1} FROM f{j})"
        for j in range(len(steps))
    )
    columns = ", ".join(f"{at}.n AS n_{j}, {at}.l AS l_{j}, {at}.r AS r_{j}" for j, at in enumerate(steps))
    return f"""
WITH entries AS (SELECT list_transform(range(256), lambda i: {entry}) AS entries),
leaves AS (
  SELECT doc_id, source, {leaf('text')} AS leaf,
    CASE WHEN {crc} % {TAMPERED} = 0 THEN {leaf(lowered)} END AS claimed
  FROM documents, entries
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM leaves
),
{_tree('d', 'SELECT tree, i, n, leaf AS digest FROM ranked')},
{_tree('s', f'SELECT 0 AS tree, tree AS i, count(*) OVER () AS n, digest FROM d{LEVELS}')},
f0 AS (SELECT ranked.doc_id, leaf, sha256({' || '.join(proof)}) AS proof_sha256, {folded} AS own_0,
  top.digest AS subroot, whole.digest AS root, {columns}
FROM ranked JOIN d{LEVELS} top ON top.tree = ranked.tree CROSS JOIN s{LEVELS} whole{joins}){folds}
SELECT doc_id, leaf, subroot, root, proof_sha256, own_{len(steps)} AS folded_root, own_{len(steps)} = root AS verified
FROM f{len(steps)}
"""


ORACLES = {"op7_url_rules": _op7(), "op12_manifest": _op12()}
