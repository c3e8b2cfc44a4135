"""Linked documents and their components as SQL, for tables small enough to compare all pairs that share an n-gram."""

from __future__ import annotations


def linked_sql(width: int, percent: int, shown: str) -> str:
    """DuckDB SQL over `documents`. `shown` names columns: n_shingles, component_id, kept, n_links."""
    columns = {
        "n_shingles": "coalesce(n.n, 0) AS n_shingles", "component_id": "component_id", "kept": "d.doc_id = component_id AS kept", "n_links": "coalesce(k.n, 0) AS n_links",
    }
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i:i + {width} - 1], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= {percent} * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
k AS (SELECT a AS doc_id, count(*) AS n FROM e GROUP BY a),
r(id, near) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.near),
c AS (SELECT id, min(near) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, {", ".join(columns[c] for c in shown.split())} FROM documents d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id"""
