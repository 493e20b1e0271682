"""The SQL (DuckDB) that each bound query must equal."""

from __future__ import annotations

import re

from workload.tables import MODEL_BASE

# Stand-in tables in SQL, as in workload.tables.
TABLES = {
    "node": "SELECT p_partkey AS id, p_name AS label, p_type AS taxon FROM part",
    "hierarchy": """
        SELECT DISTINCT child, parent FROM (
          SELECT p_partkey AS child, p_partkey // 2 AS parent FROM part WHERE p_partkey > 0 AND p_size < 50
          UNION ALL
          SELECT p_partkey, p_partkey // 3 FROM part WHERE p_partkey > 0 AND p_size <= 7)""",
    "cyclic": """
        SELECT child, parent FROM hierarchy
        UNION ALL SELECT parent, min(child) FROM hierarchy WHERE parent = 0 GROUP BY parent""",
    "xref": """
        SELECT s_suppkey AS id, s_name AS symbol, 'A' || s_suppkey || '|A' || (s_suppkey + 7) AS aliases
        FROM supplier WHERE s_acctbal >= 1500""",
    "gene": "SELECT s_suppkey AS id, s_name AS symbol, 'N' || s_nationkey AS taxon FROM supplier WHERE s_acctbal >= 1500",
    "alias_pairs": "SELECT DISTINCT unnest(string_split(aliases, '|')) AS alias, id FROM xref",
    "raw": """
        SELECT 'A' || l_suppkey || CASE WHEN l_linenumber > 5 THEN '-' || l_linenumber ELSE '' END AS accession,
               l_partkey AS pathway, l_returnflag AS code, l_linestatus AS species FROM lineitem""",
    "scoped": "SELECT accession, pathway, code, split_part(accession, '-', 1) AS base FROM raw WHERE species = 'F'",
    "facts": """
        SELECT DISTINCT m.id AS gene, s.pathway, s.code, s.accession
        FROM scoped s JOIN alias_pairs m ON m.alias = s.base""",
    "edges": "SELECT DISTINCT gene, pathway FROM facts",
    "wealthy": "SELECT s_suppkey AS gene FROM supplier WHERE s_acctbal > 8000",
    "damaged": """
        SELECT gene, pathway FROM edges WHERE gene NOT IN (SELECT gene FROM wealthy)
        UNION SELECT gene + 1, pathway FROM edges WHERE gene IN (SELECT gene FROM wealthy)""",
    "crosswalk": """
        SELECT p_partkey AS pathway, p_brand AS term FROM part WHERE p_size <= 17
        UNION SELECT p_partkey, p_type FROM part WHERE p_size <= 5""",
    "prev": "SELECT p_partkey AS id, p_name AS label FROM part WHERE p_size <> 13",
    "cur": """
        SELECT CASE WHEN p_size = 23 THEN -1 - p_partkey ELSE p_partkey END AS id,
               CASE WHEN p_brand = 'Brand#1' THEN p_brand ELSE p_name END AS label FROM part WHERE p_size <> 17""",
    "small_sets": "SELECT DISTINCT l_orderkey AS pathway, l_returnflag || l_linestatus AS gene FROM lineitem",
    "faulty": """
        SELECT p_partkey AS id, p_name AS label,
               CASE WHEN p_size = 2 THEN 'WRONG' WHEN p_size = 3 THEN NULL ELSE 'GOOD' END AS taxon
        FROM part WHERE p_size > 1
        UNION ALL SELECT p_partkey, p_brand, 'OTHER' FROM part WHERE p_size = 4""",
    "two_releases": """
        SELECT 'v1' AS graph, 'P:' || id AS s, 'rdfs:label' AS p, label AS o, 'literal' AS o_kind,
               CAST(NULL AS VARCHAR) AS o_datatype FROM prev
        UNION ALL SELECT 'v2', 'P:' || id, 'rdfs:label', label, 'literal', NULL FROM cur""",
    "association": """
        SELECT *, '_:' || sha256(gene || '|' || pathway || '|' || code || '|' || accession) AS s FROM facts""",
    "emitted": """
        SELECT 'v1' AS graph, s, p, o, o_kind, CAST(NULL AS VARCHAR) AS o_datatype, part FROM (
          SELECT 'P:' || id AS s, 'a' AS p, 'biolink:Pathway' AS o, 'iri' AS o_kind, 'pathways' AS part FROM node
          UNION ALL SELECT 'P:' || id, 'rdfs:label', label, 'literal', 'pathways' FROM node
          UNION ALL SELECT 'P:' || id, 'biolink:in_taxon', taxon, 'iri', 'pathways' FROM node
          UNION ALL SELECT 'P:' || child, 'biolink:part_of', 'P:' || parent, 'iri', 'pathways' FROM hierarchy
          UNION ALL SELECT 'HGNC:' || id, 'a', 'biolink:Gene', 'iri', 'associations' FROM gene
          UNION ALL SELECT 'HGNC:' || id, 'rdfs:label', symbol, 'literal', 'associations' FROM gene
          UNION ALL SELECT 'HGNC:' || id, 'biolink:in_taxon', taxon, 'iri', 'associations' FROM gene
          UNION ALL SELECT s, 'a', 'biolink:GeneToPathwayAssociation', 'iri', 'associations' FROM association
          UNION ALL SELECT s, 'biolink:subject', 'HGNC:' || gene, 'iri', 'associations' FROM association
          UNION ALL SELECT s, 'biolink:object', 'P:' || pathway, 'iri', 'associations' FROM association
          UNION ALL SELECT s, 'biolink:predicate', 'biolink:participates_in', 'iri', 'associations' FROM association
          UNION ALL SELECT s, 'biolink:has_evidence', code, 'iri', 'associations' FROM association
          UNION ALL SELECT s, 'biolink:primary_knowledge_source', 'infores:source', 'iri', 'associations' FROM association
          UNION ALL SELECT s, 'biolink:original_subject', 'UNIPROT:' || accession, 'literal', 'associations' FROM association
          UNION ALL SELECT 'HGNC:' || gene, 'model:participates_in', 'P:' || pathway, 'iri', 'participation' FROM edges
          UNION ALL SELECT 'P:' || pathway, 'skos:closeMatch', 'GO:' || term, 'iri', 'crosswalk' FROM crosswalk)""",
    "event_quads": f"""
        SELECT 'E:' || event_id AS s,
               CASE WHEN value < 50 THEN '{MODEL_BASE}' || event_type ELSE 'a' END AS p,
               CASE WHEN value < 20 THEN 'U:' || user_id ELSE '{MODEL_BASE}' || upper(event_type) END AS o FROM events""",
    "used_terms": f"""
        SELECT substr(iri, {len(MODEL_BASE) + 1}) AS term FROM (
          SELECT p AS iri FROM event_quads UNION ALL SELECT o FROM event_quads WHERE p = 'a')
        WHERE starts_with(iri, '{MODEL_BASE}') AND length(iri) > {len(MODEL_BASE)}""",
    "usage": "SELECT term, count(*) AS uses FROM used_terms GROUP BY term",
    "defined": "SELECT DISTINCT event_type AS term FROM events WHERE event_type IN ('view', 'click', 'purchase')",
    "sizes": "SELECT pathway, count(*) AS genes FROM edges GROUP BY pathway",
    "gene_degrees": "SELECT gene, count(*) AS pathways FROM edges GROUP BY gene",
    "all_sizes": "SELECT n.id AS pathway, coalesce(s.genes, 0) AS genes FROM node n LEFT JOIN sizes s ON s.pathway = n.id",
    "degrees": """
        SELECT n.id, count(DISTINCT u.parent) AS parents, count(DISTINCT d.child) AS children
        FROM node n LEFT JOIN hierarchy u ON u.child = n.id LEFT JOIN hierarchy d ON d.parent = n.id GROUP BY n.id""",
    "contained": """
        SELECT h.child, h.parent, c.genes AS child_genes, coalesce(x.common, 0) AS common,
               coalesce(x.common, 0)::DOUBLE / c.genes AS fraction
        FROM hierarchy h JOIN sizes c ON c.pathway = h.child JOIN sizes p ON p.pathway = h.parent
        LEFT JOIN (SELECT h.child, h.parent, count(*) AS common FROM hierarchy h
                   JOIN edges a ON a.pathway = h.child JOIN edges b ON b.pathway = h.parent AND b.gene = a.gene
                   GROUP BY h.child, h.parent) x ON x.child = h.child AND x.parent = h.parent""",
    "new_facts": """
        SELECT DISTINCT CASE WHEN gene IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 8000) THEN gene + 1 ELSE gene END AS gene,
               pathway, code, accession FROM facts""",
    "new_edges": "SELECT DISTINCT gene, pathway FROM new_facts",
    "new_hierarchy": """
        SELECT child, parent FROM hierarchy EXCEPT SELECT p_partkey, p_partkey // 3 FROM part WHERE p_size = 5
        UNION ALL SELECT p_partkey, p_partkey // 2 FROM part WHERE p_size = 50""",
    "new_sizes": "SELECT pathway, count(*) AS genes FROM new_edges GROUP BY pathway",
    "new_contained": """
        SELECT h.child, h.parent, c.genes AS child_genes, coalesce(x.common, 0) AS common,
               coalesce(x.common, 0)::DOUBLE / c.genes AS fraction
        FROM new_hierarchy h JOIN new_sizes c ON c.pathway = h.child JOIN new_sizes p ON p.pathway = h.parent
        LEFT JOIN (SELECT h.child, h.parent, count(*) AS common FROM new_hierarchy h
                   JOIN new_edges a ON a.pathway = h.child JOIN new_edges b ON b.pathway = h.parent AND b.gene = a.gene
                   GROUP BY h.child, h.parent) x ON x.child = h.child AND x.parent = h.parent""",
    "ended": "SELECT 'node:' || id AS id, taxon FROM faulty UNION ALL SELECT 'gene:' || id, taxon FROM gene",
    "spelled": """
        SELECT pathway, string_agg(gene, ',' ORDER BY gene) AS spelled, count(*) AS genes FROM small_sets GROUP BY pathway""",
    "same_sets": """
        SELECT min(pathway) AS group_id, count(*) AS sets, max(genes) AS genes, spelled
        FROM spelled GROUP BY spelled HAVING count(*) > 1""",
    "spelled_edges": """
        SELECT pathway, string_agg(gene, ',' ORDER BY gene) AS spelled, count(*) AS genes FROM edges GROUP BY pathway""",
    "same_edges": """
        SELECT min(pathway) AS group_id, count(*) AS sets, max(genes) AS genes, spelled
        FROM spelled_edges GROUP BY spelled HAVING count(*) > 1""",
    "levels": """
        SELECT child AS id, 1 AS level FROM hierarchy
        UNION SELECT h.child, l.level + 1 FROM levels l JOIN hierarchy h ON h.parent = l.id""",
    "depths": """
        SELECT n.id, coalesce(max(l.level), 0)::BIGINT AS depth FROM node n LEFT JOIN levels l ON l.id = n.id GROUP BY n.id""",
    "above": """
        SELECT child AS node, parent AS ancestor FROM hierarchy
        UNION SELECT a.node, h.parent FROM above a JOIN hierarchy h ON h.child = a.ancestor""",
    "above_cyclic": """
        SELECT child AS node, parent AS ancestor FROM cyclic
        UNION SELECT a.node, h.parent FROM above_cyclic a JOIN cyclic h ON h.child = a.ancestor""",
    "endless": """
        SELECT DISTINCT node FROM above_cyclic
        WHERE ancestor IN (SELECT node FROM above_cyclic WHERE node = ancestor)""",
    "pointers": """
        SELECT child AS node, min(parent) AS next FROM cyclic
        WHERE child IN (SELECT node FROM endless) AND parent IN (SELECT node FROM endless) GROUP BY child""",
    "walks": """
        SELECT node AS start, next AS here FROM pointers
        UNION SELECT w.start, p.next FROM walks w JOIN pointers p ON p.node = w.here""",
    "cycle": """
        SELECT 0::BIGINT AS position, min(start) AS node FROM walks WHERE start = here
        UNION ALL SELECT c.position + 1, p.next FROM cycle c JOIN pointers p ON p.node = c.node
        WHERE p.next <> (SELECT min(start) FROM walks WHERE start = here)""",
    "changes": """
        SELECT coalesce(p.id, c.id) AS id, p.label AS previous_label, c.label AS current_label,
               CASE WHEN c.id IS NULL THEN 'retired' WHEN p.id IS NULL THEN 'added' ELSE 'relabelled' END AS change
        FROM prev p FULL JOIN cur c ON c.id = p.id
        WHERE p.id IS NULL OR c.id IS NULL OR p.label <> c.label""",
    "followers": """
        SELECT r.id, r.previous_label AS label, max(a.id) AS replaced_by
        FROM changes r JOIN changes a ON a.change = 'added' AND a.current_label = r.previous_label
        WHERE r.change = 'retired' GROUP BY r.id, r.previous_label""",
    "pairs": """
        SELECT gene, pathway, sum(a) AS associations, sum(e) AS edges FROM (
          SELECT gene, pathway, 1 AS a, 0 AS e FROM facts UNION ALL SELECT gene, pathway, 0, 1 FROM damaged)
        GROUP BY gene, pathway""",
    "closed": "SELECT gene, pathway FROM edges UNION SELECT e.gene, a.ancestor FROM edges e JOIN above a ON a.node = e.pathway",
    "closed_kinds": """
        SELECT 'closed' AS memberships, * FROM closed
        UNION ALL SELECT 'without roots', * FROM closed WHERE pathway IN (SELECT child FROM hierarchy)""",
    "member_compare": """
        SELECT key, count(*) FILTER (WHERE mine) AS ours, count(*) FILTER (WHERE other) AS theirs,
               count(*) FILTER (WHERE other AND NOT mine) AS missing, count(*) FILTER (WHERE mine AND NOT other) AS extra
        FROM (SELECT coalesce(e.pathway, d.pathway) AS key, e.gene IS NOT NULL AS mine, d.gene IS NOT NULL AS other
              FROM edges e FULL JOIN damaged d ON d.pathway = e.pathway AND d.gene = e.gene)
        GROUP BY key""",
    "taxa_found": """
        SELECT t.id, count(DISTINCT f.taxon) AS taxa FROM (SELECT DISTINCT id FROM faulty) t
        LEFT JOIN faulty f ON f.id = t.id GROUP BY t.id HAVING count(DISTINCT f.taxon) <> 1""",
    "loose_ends": """
        SELECT id FROM (SELECT child AS id FROM hierarchy UNION ALL SELECT parent FROM hierarchy)
        WHERE id NOT IN (SELECT id FROM faulty)""",
    "nested": """
        SELECT h.child, h.parent, count(*) AS pairs FROM hierarchy h
        JOIN facts a ON a.pathway = h.child AND a.gene = 2 JOIN facts b ON b.pathway = h.parent AND b.gene = 2
        GROUP BY h.child, h.parent""",
    "spot": """
        SELECT (SELECT count(*) FROM facts f JOIN node n ON n.id = f.pathway WHERE f.gene = 2) AS rows,
               EXISTS (SELECT 1 FROM facts WHERE gene = 2 AND pathway = 8) AS has_required,
               (SELECT count(DISTINCT n.label) FROM facts f JOIN node n ON n.id = f.pathway
                WHERE f.gene = 2 AND (contains(upper(n.label), 'RING') OR contains(n.label, 'old'))) AS keyword_labels,
               (SELECT coalesce(sum(pairs), 0)::BIGINT FROM nested) AS nested""",
    "file_lines": f"""
        SELECT doc_id AS file, lang, unnest(string_split(lang || ':' || replace(text, ' ', ' ' || lang || ':'), chr(10))) AS line
        FROM documents WHERE lang IN ('en', 'fr')""",
    "glued_lines": """
        SELECT lang, unnest(string_split(lang || ':' || replace(text, ' ', substr('./=|-#é:', CAST(doc_id % 8 AS INT) + 1, 1) || lang || ':'), chr(10))) AS line
        FROM documents""",
    "model_lines": """
        SELECT unnest(string_split(CASE WHEN role = 'user' THEN 'model:' ELSE '    model:' END || text, chr(10))) AS line
        FROM conversations""",
}


def with_tables(sql: str) -> str:
    """Put the tables a statement uses in front of it."""
    needed: list[str] = []

    def visit(text: str, own: str | None = None) -> None:
        for name in TABLES:
            if name != own and name not in needed and re.search(rf"\b{name}\b", text):
                visit(TABLES[name], name)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({TABLES[n]})" for n in needed) + "\n" + sql


def spread(source: str, value: str, by: str = "", digits: int | None = None, cast: str = "BIGINT") -> str:
    """n, mean and nearest-rank quantiles of a column, per group."""
    shown = f"round({value}, {digits})" if digits is not None else f"{value}::{cast}"
    mean = f"sum({value}) / count(*)" if digits is None else f"round(sum({value}) / count(*), {digits})"
    over = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    picks = ", ".join(
        f"max(CASE WHEN rn = round_even({f}::DOUBLE * (n - 1), 0)::BIGINT THEN v END) AS {q}"
        for q, f in (("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95))
    )
    ranked = (
        f"SELECT {keys}{value} AS raw_value, {shown} AS v, "
        f"row_number() OVER ({over} ORDER BY {value}) - 1 AS rn, count(*) OVER ({over}) AS n FROM {source}"
    )
    mean = mean.replace(value, "raw_value")
    return (
        f"SELECT {keys}count(*) AS n, {mean} AS mean, min(v) AS min, {picks}, max(v) AS max "
        f"FROM ({ranked}){group}"
    )


def check(name: str, violations: str, detail: str, source: str, critical: bool = True) -> str:
    bad = "FAIL" if critical else "WARN"
    return f"""SELECT '{name}' AS "check", CASE WHEN violations = 0 THEN 'PASS' ELSE '{bad}' END AS status,
      {str(critical).lower()} AS critical, violations::BIGINT AS violations, detail
      FROM (SELECT {violations} AS violations, {detail} AS detail FROM {source})"""


def listed(name: str, source: str, column: str, clean: str, critical: bool = True) -> str:
    detail = (
        f"CASE WHEN count(*) = 0 THEN '{clean}' ELSE count(*) || ' found, first ' "
        f"|| coalesce(min({column})::VARCHAR, 'none') END"
    )
    return check(name, "count(*)", detail, source, critical)


def chk_count(expected: int) -> str:
    n = "count(DISTINCT id)"
    wrong = f"CASE WHEN abs({n} - {expected}) / {expected}::DOUBLE > 0.05 THEN 1 ELSE 0 END"
    detail = f"{n} || ' nodes, expected {expected}'"
    return check("4. node count", wrong, detail, "node")


def chk_shapes(edges: str) -> str:
    pairs = f"""(SELECT gene, pathway, sum(a) AS a, sum(e) AS e FROM (
      SELECT gene, pathway, 1 AS a, 0 AS e FROM facts UNION ALL SELECT gene, pathway, 0, 1 FROM {edges})
      GROUP BY gene, pathway)"""
    return check(
        "9. edges match the associations", "count(*) FILTER (WHERE a = 0 OR e = 0)",
        "sum(e)::BIGINT || ' edges, ' || count(*) FILTER (WHERE a = 0) || ' with no association behind them, ' "
        "|| count(*) FILTER (WHERE e = 0) || ' pairs without an edge'",
        pairs,
    )


def chk_total(low: int, high: int) -> str:
    return check(
        "11. statement count in range", f"CASE WHEN count(*) BETWEEN {low} AND {high} THEN 0 ELSE 1 END",
        f"count(*) || ' statements, range {low} to {high}'",
        "(SELECT DISTINCT graph, s, p, o, o_kind, o_datatype FROM emitted)",
    )


EVIDENCE = check(
    "7. evidence is the mapped set",
    "count(DISTINCT CASE WHEN code NOT IN ('A', 'R') THEN code END) + count(*) FILTER (WHERE code IS NULL)",
    "'unexpected codes: ' || count(DISTINCT CASE WHEN code NOT IN ('A', 'R') THEN code END) "
    "|| coalesce(' from ' || min(CASE WHEN code NOT IN ('A', 'R') THEN code END), '') "
    "|| '; without evidence: ' || count(*) FILTER (WHERE code IS NULL)",
    "facts",
)
MEMBERS = check(
    "10. members match the other source", "count(*) FILTER (WHERE missing > 0 OR extra > 0)",
    "count(*) FILTER (WHERE missing > 0 OR extra > 0) || ' of ' || count(*) || ' differ'", "member_compare", critical=False,
)
TERMS = check(
    "12. model terms are defined", "count(*) FILTER (WHERE d.term IS NULL)",
    "count(*) FILTER (WHERE d.term IS NULL) || ' of ' || count(*) || ' undefined'",
    "usage u LEFT JOIN defined d ON d.term = u.term", critical=False,
)
SPOT = check(
    "8. spot check of one gene",
    "(rows = 0)::INT + (NOT has_required)::INT + (keyword_labels = 0)::INT + (nested = 0)::INT",
    "CASE WHEN rows > 0 AND has_required AND keyword_labels > 0 AND nested > 0 "
    "THEN rows || ' pathways, ' || nested || ' nested pairs' ELSE concat_ws('; ', "
    "CASE WHEN rows = 0 THEN 'no pathways' END, CASE WHEN NOT has_required THEN 'required pathway absent' END, "
    "CASE WHEN keyword_labels = 0 THEN 'no keyword label' END, CASE WHEN nested = 0 THEN 'one level only' END) END",
    "spot",
)
ENTITIES = "(SELECT 'node:' || id AS id, taxon FROM node UNION ALL SELECT 'gene:' || id, taxon FROM gene)"
CARDINALITY = f"""(SELECT id FROM {ENTITIES} GROUP BY id HAVING count(DISTINCT taxon) <> 1)"""

SPREAD_ITEMS = ("n", "mean", "min", "p25", "median", "p75", "p95", "max")
MEASURES = """(
  SELECT 'parents_per_pathway' AS measure, parents AS value FROM degrees
  UNION ALL SELECT 'children_per_pathway', children FROM degrees
  UNION ALL SELECT 'depth_below_root', depth FROM depths
  UNION ALL SELECT 'genes_per_pathway', genes FROM all_sizes
  UNION ALL SELECT 'pathways_per_gene', pathways FROM gene_degrees
  UNION ALL SELECT 'terms_per_pathway', count(*) FROM crosswalk GROUP BY pathway)"""


def _row(section: str, metric: str, item: str, value: str, source: str, label: str = "''") -> str:
    return f"SELECT '{section}' AS section, {metric} AS metric, {item} AS item, ({value})::DOUBLE AS value, {label} AS label FROM {source}"


def _unpivot(source: str, metric: str) -> list[str]:
    return [_row("distribution", metric, f"'{i}'", f'"{i}"', source) for i in SPREAD_ITEMS]


def report() -> str:
    q = lambda text: f"'{text}'"
    one = "(SELECT 1)"
    label_of = lambda key: f"coalesce((SELECT max(label) FROM node n WHERE n.id = {key}), '')"
    spreads = f"({spread(MEASURES, 'value', 'measure')})"
    shares = f"({spread('contained', 'fraction', digits=4)})"
    top_group = "(SELECT spelled FROM same_edges ORDER BY sets DESC, group_id LIMIT 1)"
    rows = [
        _row("types", q("GeneToPathwayAssociation"), q(""), "count(*)", "facts"),
        _row("types", q("Pathway"), q(""), "count(*)", "node"),
        _row("types", q("Gene"), q(""), "count(*)", "gene"),
        "SELECT 'taxa', 'nodes', taxon, count(*)::DOUBLE, '' FROM (SELECT taxon FROM node UNION ALL SELECT taxon FROM gene) GROUP BY taxon",
        _row("coverage", q("genes"), q(""), "count(DISTINCT id)", "gene"),
        _row("coverage", q("genes_with_symbol"), q(""), "count(DISTINCT id) FILTER (WHERE symbol <> '')", "gene"),
        _row("coverage", q("genes_in_association"), q(""), "count(DISTINCT gene)", "edges"),
        _row("coverage", q("pathways"), q(""), "count(DISTINCT id)", "node"),
        _row("coverage", q("pathways_with_set"), q(""), "count(DISTINCT pathway)", "edges"),
        _row("coverage", q("pathways_with_term"), q(""), "count(DISTINCT pathway)", "crosswalk"),
        _row("hierarchy", q("part_of_edges"), q(""), "sum(parents)", "degrees"),
        _row("hierarchy", q("roots"), q(""), "count(*) FILTER (WHERE parents = 0)", "degrees"),
        _row("hierarchy", q("leaves"), q(""), "count(*) FILTER (WHERE children = 0)", "degrees"),
        _row("hierarchy", q("multi_parent"), q(""), "count(*) FILTER (WHERE parents > 1)", "degrees"),
        _row("hierarchy", q("endless_nodes"), q(""), "0", one),
        _row("hierarchy", q("root"), "id::VARCHAR", "children", "degrees d WHERE parents = 0", label_of("d.id")),
        *_unpivot(spreads, "measure"),
        "SELECT 'associations', 'evidence', code, count(*)::DOUBLE, '' FROM facts GROUP BY code",
        "SELECT 'associations', 'unmapped_code', code, count(*)::DOUBLE, '' FROM facts WHERE code NOT IN ('A', 'R') GROUP BY code",
        _row("associations", q("unmapped_codes"), q(""), "count(DISTINCT code) FILTER (WHERE code NOT IN ('A', 'R'))", "facts"),
        _row("associations", q("knowledge_source"), q("infores:source"), "count(*)", "facts"),
        _row("associations", q("source_accessions"), q(""), "count(DISTINCT accession)", "facts"),
        _row("associations", q("isoform_accessions"), q(""), "count(DISTINCT accession) FILTER (WHERE contains(accession, '-'))", "facts"),
        _row("participation", q("edges"), q(""), "count(*)", "edges"),
        _row("participation", q("association_pairs"), q(""), "count(*)", "edges"),
        _row("participation", q("matches"), q(""), "1", one),
        _row("participation", q("associations_per_edge"), q(""), "round((SELECT count(*) FROM facts)::DOUBLE / count(*), 3)", "edges"),
        _row("gene_sets", q("without_genes"), q(""), "count(*) FILTER (WHERE genes = 0)", "all_sizes"),
        _row("gene_sets", q("in_band"), q(""), "count(*) FILTER (WHERE genes BETWEEN 15 AND 22)", "sizes"),
        _row("gene_sets", q("below_band"), q(""), "count(*) FILTER (WHERE genes < 15)", "sizes"),
        _row("gene_sets", q("above_band"), q(""), "count(*) FILTER (WHERE genes > 22)", "sizes"),
        _row("gene_sets", q("largest"), "pathway::VARCHAR", "genes", "(SELECT * FROM sizes ORDER BY genes DESC, pathway LIMIT 20) s", label_of("s.pathway")),
        _row("gene_sets", q("hub"), "gene::VARCHAR", "pathways", "(SELECT * FROM gene_degrees ORDER BY pathways DESC, gene LIMIT 20) h",
             "coalesce((SELECT max(symbol) FROM gene g WHERE g.id = h.gene), '')"),
        _row("propagation", q("pairs_compared"), q(""), "count(*)", "contained"),
        _row("propagation", q("fully_contained"), q(""), "count(*) FILTER (WHERE common = child_genes)", "contained"),
        _row("propagation", q("fully_contained_fraction"), q(""),
             "round(count(*) FILTER (WHERE common = child_genes)::DOUBLE / greatest(count(*), 1), 4)", "contained"),
        *_unpivot(shares, q("child_genes_in_parent")),
        _row("propagation", q("identical_groups"), q(""), "count(*)", "same_edges"),
        _row("propagation", q("sets_in_identical_groups"), q(""), "coalesce(sum(sets), 0)", "same_edges"),
        _row("propagation", q("largest_identical"), "pathway::VARCHAR", "genes", f"spelled_edges e WHERE spelled IN {top_group}", label_of("e.pathway")),
        _row("crosswalk", q("edges"), q(""), "count(*)", "crosswalk"),
        "SELECT 'statements', 'part', part, count(*)::DOUBLE, '' FROM emitted GROUP BY part",
    ]
    return "\nUNION ALL ".join(rows)


ESCAPED = (
    "replace(replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), "
    "chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"
)
LICENCE = (
    "CASE WHEN lower(coalesce(nullif(license_id, ''), 'cc-by-4.0')) LIKE 'cc-by-4%' "
    "THEN 'https://creativecommons.org/licenses/by/4.0/' ELSE 'https://spdx.org/licenses/' || lower(license_id) END"
)
METADATA = f"""
WITH described AS (
  SELECT 'urn:kg:release:v' || o_orderkey AS s, 'v' || o_orderkey AS version, o_custkey AS triples,
    CASE WHEN o_orderstatus = 'F' THEN 'https://example.org/' || o_custkey ELSE 'https://doi.org/10.1/' || o_custkey END AS source,
    CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m') || '-01'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS issued,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'CC-BY-4.0' WHEN o_orderpriority = '2-HIGH' THEN ''
         ELSE o_orderpriority END AS license_id FROM orders)
SELECT DISTINCT * FROM (
  SELECT s, 'a' AS p, 'void:Dataset' AS o, 'iri' AS o_kind, CAST(NULL AS VARCHAR) AS o_datatype FROM described
  UNION ALL SELECT s, 'rdfs:label', 'Release ' || version, 'literal', NULL FROM described
  UNION ALL SELECT s, 'dcterms:source', source, 'iri', NULL FROM described
  UNION ALL SELECT s, 'pav:version', upper(version), 'literal', NULL FROM described
  UNION ALL SELECT s, 'dcterms:license', {LICENCE}, 'iri', NULL FROM described
  UNION ALL SELECT s, 'void:triples', triples::VARCHAR, 'literal', 'xsd:integer' FROM described
  UNION ALL SELECT s, 'biolink:in_taxon', 'NCBITaxon:9606', 'iri', NULL FROM described
  UNION ALL SELECT s, 'prov:wasGeneratedBy', 'urn:kg:ingest:2026-01-31', 'iri', NULL FROM described
  UNION ALL SELECT s, 'dcterms:issued', issued, 'literal', 'xsd:date' FROM described WHERE issued IS NOT NULL
  UNION ALL SELECT 'urn:kg:ingest:2026-01-31', 'a', 'prov:Activity', 'iri', NULL FROM described
  UNION ALL SELECT 'urn:kg:ingest:2026-01-31', 'rdfs:label', 'Release ingest, 2026-01-31', 'literal', NULL FROM described
  UNION ALL SELECT 'urn:kg:ingest:2026-01-31', 'prov:used', source, 'iri', NULL FROM described
  UNION ALL SELECT 'urn:kg:ingest:2026-01-31', 'prov:endedAtTime', '2026-01-31', 'literal', 'xsd:date' FROM described)"""


def folded(*columns: str) -> str:
    """Row hash over length-prefixed values, as in the fingerprint."""
    return " || ".join(
        f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in columns
    )


def rule(name: str, source: str, broken: str, column: str, right: str = "TRUE") -> str:
    return (
        f"SELECT '{name}' AS rule, count(*) AS rows, count(*) FILTER (WHERE ({right}) AND ({broken})) AS violations, "
        f"min({column}::VARCHAR) FILTER (WHERE ({right}) AND ({broken})) AS sample FROM {source}"
    )


LAYOUT_ROWS = "(SELECT *, CASE WHEN c_acctbal < 0 THEN 3 ELSE 2 END AS n_fields FROM customer)"
NEW_WORD = r"(?:^|[^:A-Za-z0-9_#-])"
LOCAL = "([A-Za-z_][A-Za-z_0-9]*)"

SQL = {
    "payload_sniff": """
        SELECT kind, coalesce(NOT starts_with(ltrim(content, ' ' || chr(9) || chr(10) || chr(13)), '<')
               AND contains(split_part(content, chr(10), 1), chr(9)), FALSE) AS tabular, count(*) AS files
        FROM (SELECT 'page' AS kind, html AS content FROM pages UNION ALL SELECT 'document', text FROM documents
              UNION ALL SELECT 'table', o_orderkey || chr(9) || o_orderstatus FROM orders) GROUP BY 1, 2""",
    "quoted_records": """
        SELECT file, position // 7 AS block, position, record FROM (
          SELECT doc_id::VARCHAR AS file, 0 AS position, '"' || replace(text, '"', '""') || '"' || chr(9) || lang AS record FROM documents
          UNION ALL
          SELECT doc_id::VARCHAR, length(text) - length(replace(text, chr(10), '')) + 1, source || ' 5" wide' || chr(9) || '"' || lang || '"'
          FROM documents)""",
    "manifest_compare": """
        SELECT doc_id::VARCHAR AS filename, md5(text) AS ours_md5,
               md5(CASE WHEN lang = 'de' THEN text || '.' ELSE text END) AS theirs_md5, lang <> 'de' AS same
        FROM documents WHERE lang <> 'es'""",
    "emit_quads": "SELECT graph, s, p, o, o_kind, o_datatype, part FROM emitted",
    "statements_per_part": "SELECT part, count(*) AS statements FROM emitted GROUP BY part",
    "nquads_lines": f"""
        SELECT '<https://example.org/pathway/' || doc_id || '> <http://www.w3.org/2000/01/rdf-schema#comment> "'
               || {ESCAPED} || '"' || CASE WHEN lang = 'en' THEN '^^<http://www.w3.org/2001/XMLSchema#string>' ELSE '' END
               || ' <urn:kg:release:v1> .' AS line FROM documents""",
    "parse_statements": """
        SELECT 'urn:kg:release:v1' AS graph, 'https://example.org/pathway/' || doc_id AS s,
               'http://www.w3.org/2000/01/rdf-schema#comment' AS p, text AS o, 'literal' AS o_kind,
               CASE WHEN lang = 'en' THEN 'http://www.w3.org/2001/XMLSchema#string' END AS o_datatype FROM documents""",
    "release_metadata": METADATA,
    "upsert_metadata": """
        SELECT graph AS s, p, o FROM two_releases WHERE graph <> 'v2'
        UNION SELECT 'v2', 'void:entry', label FROM cur""",
    "snapshot_fingerprint": f"""
        SELECT count(*) AS rows, sum(h)::VARCHAR AS folded, bit_xor(h) AS mixed
        FROM (SELECT ('0x' || substr(md5({folded('accession', 'code', 'gene', 'pathway')}), 1, 15))::BIGINT AS h FROM facts)""",
    "key_shape": r"""
        SELECT CASE WHEN regexp_matches(key, '^\d{4}-\d{2}-\d{2}$') THEN 'date'
                    WHEN regexp_matches(key, '^[vV][0-9]') THEN 'release_tag' ELSE 'invalid' END AS class,
               regexp_matches(portal, '^[a-z0-9][a-z0-9-]*$') AS portal_ok, count(*) AS keys
        FROM (SELECT CASE o_orderstatus WHEN 'P' THEN 'v' || o_orderkey WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
                     ELSE year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate) END AS key,
                     CASE WHEN o_orderstatus = 'O' THEN lower(o_orderpriority) ELSE o_orderpriority END AS portal
              FROM orders) GROUP BY 1, 2""",
    "scope_filter": "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en'",
    "scope_tally": "SELECT lang AS name, count(*) AS rows, lang = 'en' AS kept FROM documents GROUP BY lang",
    "scope_unknown": "SELECT lang AS name, count(*) AS rows FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY lang",
    "scope_edges": """
        SELECT CASE ends WHEN 2 THEN 'kept' WHEN 1 THEN 'mixed' ELSE 'dropped' END AS scope, count(*) AS edges
        FROM (SELECT (c.taxon = 'PROMO')::INT + (p.taxon = 'PROMO')::INT AS ends
              FROM hierarchy h JOIN node c ON c.id = h.child JOIN node p ON p.id = h.parent) GROUP BY ends""",
    "map_codes": """
        SELECT code, CASE code WHEN 'A' THEN 'ECO:1' WHEN 'R' THEN 'ECO:2' END AS term, count(*) AS rows
        FROM raw GROUP BY 1, 2""",
    "unknown_codes": "SELECT code, count(*) AS rows FROM raw WHERE code NOT IN ('A', 'R') GROUP BY code",
    "in_scope_facts": "SELECT * FROM facts WHERE pathway IN (SELECT id FROM node WHERE taxon = 'PROMO')",
    "off_scope_facts": "SELECT count(*) AS rows FROM facts WHERE pathway NOT IN (SELECT id FROM node WHERE taxon = 'PROMO')",
    "expand_curie": """
        SELECT p_partkey AS id,
          CASE WHEN p_size <= 20 THEN 'P' WHEN p_size <= 40 THEN 'GO' ELSE 'unknown' END || ':' || p_partkey || ':x' AS curie,
          CASE WHEN p_size <= 20 THEN 'https://example.org/p/' WHEN p_size <= 40 THEN 'http://purl.obolibrary.org/obo/GO_' END
            || p_partkey || ':x' AS iri FROM part""",
    "mint_curie": "SELECT id, 'HGNC:' || id AS kept, 'HGNC:' || id AS minted FROM gene",
    "base_accession": """
        SELECT split_part(accession, '-', 1) AS base, count(*) AS rows,
               count(*) FILTER (WHERE contains(accession, '-')) AS isoform_rows FROM raw GROUP BY 1""",
    "model_term": f"""
        SELECT s, CASE WHEN starts_with(p, '{MODEL_BASE}') THEN substr(p, {len(MODEL_BASE) + 1}) END AS term FROM event_quads""",
    "verify_layout": "\nUNION ALL ".join([
        f"SELECT 'arity' AS rule, count(*) AS rows, count(*) FILTER (WHERE n_fields <> 2) AS violations, "
        f"min(n_fields) FILTER (WHERE n_fields <> 2)::VARCHAR AS sample FROM {LAYOUT_ROWS}",
        f"SELECT 'not_empty', count(*), (count(*) = 0)::BIGINT, NULL FROM {LAYOUT_ROWS}",
        rule("c_name:pattern", LAYOUT_ROWS, r"NOT regexp_matches(c_name, '^Customer#\d{9}$')", "c_name", "n_fields = 2"),
        rule("c_mktsegment:required", LAYOUT_ROWS, "trim(c_mktsegment) = ''", "c_mktsegment", "n_fields = 2"),
        rule("c_mktsegment:enum", LAYOUT_ROWS, "c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')",
             "c_mktsegment", "n_fields = 2"),
    ]),
    "layout_samples": """
        SELECT rule, row_number() OVER (PARTITION BY rule ORDER BY value COLLATE "C")::INT AS place, value, rows FROM (
          SELECT rule, value, count(*) AS rows FROM (
            SELECT 'arity' AS rule, '2' AS value FROM orders WHERE o_totalprice > 400000
            UNION ALL SELECT 'key:pattern', o_orderkey::VARCHAR FROM orders WHERE NOT o_totalprice > 400000 AND contains(o_orderkey::VARCHAR, '9')
            UNION ALL SELECT 'priority:enum', o_orderpriority FROM orders WHERE NOT o_totalprice > 400000 AND o_orderpriority NOT IN ('1-URGENT', '5-LOW')
            UNION ALL SELECT 'status:required', ' ' FROM orders WHERE o_totalprice < 20000)
          GROUP BY rule, value)
        QUALIFY place <= 20""",
    "slot_rules": "\nUNION ALL ".join([
        rule("o_orderstatus:required", "orders", "o_orderstatus IS NULL OR trim(o_orderstatus) = ''", "o_orderstatus"),
        rule("o_orderstatus:enum", "orders", "o_orderstatus NOT IN ('F', 'O')", "o_orderstatus"),
        rule("o_orderpriority:pattern", "orders", r"NOT regexp_matches(o_orderpriority, '^\d-[A-Z]+$')", "o_orderpriority"),
        rule("o_orderpriority:equals", "orders", "o_orderpriority <> '5-LOW'", "o_orderpriority"),
        rule("o_totalprice:minimum", "orders", "o_totalprice < 10000.0", "o_totalprice"),
    ]),
    "alias_map": "SELECT alias, id FROM alias_pairs",
    "resolve_fanout": "SELECT gene, pathway, code, accession FROM facts",
    "participation_edges": "SELECT gene, pathway FROM edges",
    "fanout_rows": """
        SELECT coalesce(m.n, 0) AS matches, count(*) AS rows FROM scoped s
        LEFT JOIN (SELECT alias, count(*) AS n FROM alias_pairs GROUP BY alias) m ON m.alias = s.base GROUP BY 1""",
    "unresolved": """
        SELECT accession, count(*) AS rows, min({'p': pathway, 'c': code}).p AS example_pathway,
               min({'p': pathway, 'c': code}).c AS evidence
        FROM scoped WHERE base NOT IN (SELECT alias FROM alias_pairs) GROUP BY accession""",
    "unresolved_fraction": """
        SELECT count(*) AS rows_in_scope, count(*) FILTER (WHERE lost) AS unresolved_rows,
               count(*) FILTER (WHERE lost)::DOUBLE / count(*) AS fraction
        FROM (SELECT base NOT IN (SELECT alias FROM alias_pairs) AS lost FROM scoped)""",
    "evidence_rows": "SELECT code, count(*) AS rows FROM scoped GROUP BY code",
    "ingest_facts": """
        SELECT gene, pathway::VARCHAR AS pathway, CASE code WHEN 'A' THEN 'ECO:1' WHEN 'R' THEN 'ECO:2' ELSE 'ECO:3' END AS code,
               accession FROM facts""",
    "gene_pathway_count": """
        SELECT g.symbol, count(DISTINCT e.pathway) AS pathway_count FROM edges e JOIN gene g ON g.id = e.gene
        WHERE g.symbol = 'Supplier#000000002' GROUP BY g.symbol""",
    "gene_pathways": """
        SELECT n.label, f.code AS evidence FROM facts f JOIN gene g ON g.id = f.gene JOIN node n ON n.id = f.pathway
        WHERE g.symbol = 'Supplier#000000002' ORDER BY n.label""",
    "gene_pathways_clustered": """
        SELECT n.label, f.code AS evidence FROM facts f JOIN gene g ON g.id = f.gene JOIN node n ON n.id = f.pathway
        WHERE g.symbol = 'Supplier#000000002' ORDER BY n.label""",
    "gene_panel": """
        SELECT p.symbol, count(DISTINCT e.pathway) AS pathway_count
        FROM (VALUES ('Supplier#000000002'), ('Supplier#000000003'), ('Supplier#000000009'), ('Supplier#absent')) p(symbol)
        LEFT JOIN gene g ON g.symbol = p.symbol LEFT JOIN edges e ON e.gene = g.id GROUP BY p.symbol""",
    "hub_by_symbol": """
        SELECT g.symbol, count(DISTINCT e.pathway) AS pathway_count FROM edges e JOIN gene g ON g.id = e.gene
        GROUP BY g.symbol ORDER BY pathway_count DESC, g.symbol LIMIT 10""",
    "shared_pathways": """
        SELECT n.label FROM edges a JOIN gene ga ON ga.id = a.gene AND ga.symbol = 'Supplier#000000002'
        JOIN edges b ON b.pathway = a.pathway JOIN gene gb ON gb.id = b.gene AND gb.symbol = 'Supplier#000000009'
        JOIN node n ON n.id = a.pathway ORDER BY n.label""",
    "evidence_breakdown": """
        SELECT f.code AS evidence, count(*) AS n FROM facts f JOIN gene g ON g.id = f.gene
        WHERE g.symbol = 'Supplier#000000002' GROUP BY f.code""",
    "terms_for_gene": """
        SELECT DISTINCT c.term FROM edges e JOIN gene g ON g.id = e.gene JOIN crosswalk c ON c.pathway = e.pathway
        WHERE g.symbol = 'Supplier#000000002'""",
    "raw_sql": """
        SELECT n.taxon, f.code, count(DISTINCT f.gene) AS genes FROM facts f JOIN node n ON n.id = f.pathway
        GROUP BY n.taxon, f.code""",
    "hub_by_id": """
        SELECT d.gene, coalesce(g.symbol, '') AS symbol, d.pathways
        FROM (SELECT * FROM gene_degrees ORDER BY pathways DESC, gene LIMIT 20) d LEFT JOIN gene g ON g.id = d.gene""",
    "largest_sets": """
        SELECT s.pathway, n.label, s.genes FROM (SELECT * FROM sizes ORDER BY genes DESC, pathway LIMIT 20) s
        JOIN node n ON n.id = s.pathway""",
    "set_size_distribution": spread("""(SELECT 'genes_per_pathway' AS measure, genes AS value FROM all_sizes
        UNION ALL SELECT 'pathways_per_gene', pathways FROM gene_degrees)""", "value", "measure"),
    "scoring_band": """
        SELECT count(*) FILTER (WHERE genes BETWEEN 15 AND 22) AS in_band, count(*) FILTER (WHERE genes < 15) AS below_band,
               count(*) FILTER (WHERE genes > 22) AS above_band FROM sizes""",
    "empty_sets": """
        SELECT id AS pathway FROM node WHERE id NOT IN (
          SELECT pathway FROM edges WHERE gene IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 9000))""",
    "containment": "SELECT child, parent, child_genes, common, fraction FROM contained",
    "containment_summary": f"""
        SELECT s.*, f.fully_contained, round(f.fully_contained::DOUBLE / greatest(s.pairs_compared, 1), 4) AS fully_contained_fraction
        FROM (SELECT n AS pairs_compared, mean, min, p25, median, p75, p95, max FROM ({spread('contained', 'fraction', digits=4)})) s,
             (SELECT count(*) FILTER (WHERE common = child_genes) AS fully_contained FROM contained) f""",
    "advanced_measures": """
        SELECT 'genes' AS measure, pathway::VARCHAR AS item, genes AS value FROM new_sizes
        UNION ALL SELECT 'pathways', gene::VARCHAR, count(*) FROM new_edges GROUP BY gene
        UNION ALL SELECT 'common', child || '-' || parent, common FROM new_contained WHERE common > 0
        UNION ALL SELECT 'facts', code, count(*) FROM new_facts GROUP BY code""",
    "advanced_containment": f"""
        SELECT s.*, f.fully_contained, round(f.fully_contained::DOUBLE / greatest(s.pairs_compared, 1), 4) AS fully_contained_fraction
        FROM (SELECT n AS pairs_compared, mean, min, p25, median, p75, p95, max FROM ({spread('new_contained', 'fraction', digits=4)})) s,
             (SELECT count(*) FILTER (WHERE common = child_genes) AS fully_contained FROM new_contained) f""",
    "identical_sets": "SELECT group_id, sets, genes FROM same_sets",
    "largest_identical_group": """
        SELECT pathway, genes FROM spelled
        WHERE spelled = (SELECT spelled FROM same_sets ORDER BY sets DESC, group_id LIMIT 1)""",
    "reconcile_sets": "SELECT *, missing = 0 AND extra = 0 AS exact_match FROM member_compare",
    "reconcile_by_digest": "SELECT *, missing = 0 AND extra = 0 AS exact_match FROM member_compare",
    "reconcile_sample": """
        SELECT *, missing = 0 AND extra = 0 AS exact_match FROM member_compare WHERE key IN (
          SELECT pathway FROM (SELECT DISTINCT pathway, md5(pathway || ':97') AS h FROM edges ORDER BY h, pathway LIMIT 100))""",
    "first_lines": "SELECT 'd' || doc_id AS file, rtrim(string_split(text, chr(10))[1], chr(13)) AS head FROM documents",
    "trim_blanks": "SELECT id, label AS trimmed, length(label) AS n FROM node",
    "seeded_sample": "SELECT DISTINCT pathway FROM (SELECT DISTINCT pathway, md5(pathway || ':97') AS h FROM edges ORDER BY h, pathway LIMIT 5)",
    "reconcile_shapes": """
        SELECT sum(edges)::BIGINT AS edges, count(*) AS pairs, count(*) FILTER (WHERE associations = 0) AS unsupported,
               count(*) FILTER (WHERE edges = 0) AS unreachable FROM pairs""",
    "shape_agreement": """
        SELECT (SELECT count(*) FROM edges) AS edges, count(DISTINCT (gene, pathway)) AS association_pairs, count(*) AS associations,
               TRUE AS matches, round(count(*)::DOUBLE / (SELECT count(*) FROM edges), 3) AS associations_per_edge FROM facts""",
    "pair_evidence_profile": """
        SELECT CASE WHEN a AND r THEN 'both' WHEN a THEN 'curated_only' WHEN r THEN 'inferred_only' ELSE 'other' END AS profile,
               count(*) AS pairs
        FROM (SELECT bool_or(code = 'A') AS a, bool_or(code = 'R') AS r FROM facts GROUP BY gene, pathway) GROUP BY 1""",
    "evidence_mix": "SELECT code, count(*) AS facts, code IN ('A', 'R') AS mapped FROM facts GROUP BY code",
    "value_histogram": """
        SELECT 'l_returnflag' AS column, l_returnflag AS value, count(*) AS rows FROM lineitem GROUP BY 2
        UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2
        UNION ALL SELECT 'l_linenumber', l_linenumber::VARCHAR, count(*) FROM lineitem GROUP BY 2""",
    "distribution": spread("lineitem", "l_suppkey", "l_returnflag"),
    "distribution_doubles": spread("customer", "c_acctbal", "c_mktsegment", digits=2),
    "type_tally": """
        SELECT p, o, count(*) AS statements FROM emitted
        WHERE p IN ('a', 'biolink:in_taxon', 'biolink:primary_knowledge_source') GROUP BY p, o""",
    "coverage": """
        SELECT 'genes' AS measure, count(DISTINCT id) AS n FROM gene
        UNION ALL SELECT 'genes_with_symbol', count(DISTINCT id) FROM gene WHERE symbol <> ''
        UNION ALL SELECT 'genes_in_association', count(DISTINCT gene) FROM edges
        UNION ALL SELECT 'pathways', count(DISTINCT id) FROM node
        UNION ALL SELECT 'pathways_with_set', count(DISTINCT pathway) FROM edges
        UNION ALL SELECT 'pathways_with_term', count(DISTINCT pathway) FROM crosswalk""",
    "accession_counts": """
        SELECT count(DISTINCT accession) AS source_accessions,
               count(DISTINCT accession) FILTER (WHERE contains(accession, '-')) AS isoform_accessions FROM facts""",
    "crosswalk_summary": f"""
        SELECT n AS pathways_with_term, (SELECT count(*) FROM crosswalk) AS edges, mean, min, p25, median, p75, p95, max
        FROM ({spread('(SELECT count(*) AS terms FROM crosswalk GROUP BY pathway)', 'terms')})""",
    "select_release": "SELECT * FROM two_releases WHERE graph = 'v2'",
    "select_union": "SELECT DISTINCT s, p, o, o_kind, o_datatype FROM two_releases",
    "bgp_match": """
        SELECT g.symbol, count(*) AS solutions, count(DISTINCT h.parent) AS parents
        FROM facts f JOIN hierarchy h ON h.child = f.pathway JOIN gene g ON g.id = f.gene GROUP BY g.symbol""",
    "bgp_match_ids": """
        SELECT g.symbol, count(*) AS solutions, count(DISTINCT h.parent) AS parents
        FROM facts f JOIN hierarchy h ON h.child = f.pathway JOIN gene g ON g.id = f.gene GROUP BY g.symbol""",
    "distinct_encoded": "SELECT graph, count(*) AS statements FROM two_releases GROUP BY graph",
    "graph_set": "SELECT graph, count(*) AS statements FROM two_releases GROUP BY graph",
    "term_usage": "SELECT term, uses FROM usage",
    "undefined_terms": "SELECT term, uses FROM usage WHERE term NOT IN (SELECT term FROM defined)",
    "emitted_terms": rf"""
        SELECT term, count(*) AS uses FROM (
          SELECT unnest(regexp_extract_all(line, '{NEW_WORD}' || lang || ':{LOCAL}', 1)) AS term FROM file_lines
          WHERE NOT starts_with(ltrim(line), '#')) GROUP BY term""",
    "emitted_terms_glued": rf"""
        SELECT term, count(*) AS uses FROM (
          SELECT unnest(regexp_extract_all(line, '(?:^|[^:_\pL\pN#-])' || lang || ':{LOCAL}', 1)) AS term FROM glued_lines
          WHERE NOT starts_with(ltrim(line), '#')) GROUP BY term""",
    "defined_terms": r"""
        SELECT DISTINCT substr(subject, 7) AS term FROM (SELECT regexp_extract(line, '^([^\s#@]\S*)', 1) AS subject FROM model_lines)
        WHERE starts_with(subject, 'model:') AND length(subject) > 6""",
    "find_cycle_nodes": "SELECT node FROM endless",
    "name_cycle": "SELECT position, node FROM cycle",
    "depth": "SELECT id, depth FROM depths",
    "hierarchy_shape": """
        SELECT sum(parents)::BIGINT AS part_of_edges, count(*) FILTER (WHERE parents = 0) AS roots,
               count(*) FILTER (WHERE children = 0) AS leaves, count(*) FILTER (WHERE parents > 1) AS multi_parent FROM degrees""",
    "degree_distributions": spread("""(SELECT 'parents' AS measure, parents AS value FROM degrees
        UNION ALL SELECT 'children', children FROM degrees)""", "value", "measure"),
    "roots": """
        SELECT d.id AS pathway, n.label, d.children AS direct_children FROM degrees d JOIN node n ON n.id = d.id
        WHERE d.parents = 0""",
    "ancestors": "SELECT node, ancestor FROM above",
    "gene_ancestors": """
        SELECT gene, pathway AS ancestor FROM edges
        UNION SELECT e.gene, a.ancestor FROM edges e JOIN above a ON a.node = e.pathway""",
    "ancestors_of": "SELECT node, ancestor FROM above WHERE node IN (SELECT id FROM node WHERE taxon = 'PROMO')",
    "indexed_ancestors_of": "SELECT node, ancestor FROM above WHERE node <> ancestor AND node IN (SELECT id FROM node WHERE taxon = 'PROMO')",
    "indexed_ancestor_counts": "SELECT node, count(*) AS ancestors FROM above WHERE node <> ancestor GROUP BY node",
    "gene_ancestors_of": """
        SELECT gene, pathway AS ancestor FROM edges WHERE gene = 2
        UNION SELECT e.gene, a.ancestor FROM edges e JOIN above a ON a.node = e.pathway WHERE e.gene = 2""",
    "closure_violations": """
        SELECT DISTINCT e.gene, h.parent AS pathway FROM edges e JOIN hierarchy h ON h.child = e.pathway
        WHERE NOT EXISTS (SELECT 1 FROM edges x WHERE x.gene = e.gene AND x.pathway = h.parent)""",
    "closed_memberships": """
        SELECT k.memberships, count(i.gene) AS violations
        FROM (VALUES ('closed'), ('without roots')) k(memberships)
        LEFT JOIN (SELECT DISTINCT memberships, gene, parent AS pathway FROM closed_kinds JOIN hierarchy ON child = pathway
                   EXCEPT SELECT * FROM closed_kinds) i ON i.memberships = k.memberships GROUP BY k.memberships""",
    "release_diff": "SELECT id, previous_label, current_label, change FROM changes",
    "release_diff_by_digest": "SELECT id, previous_label, current_label, change FROM changes",
    "table_difference": """
        SELECT gene, pathway, sum(l)::BIGINT AS left_rows, sum(r)::BIGINT AS right_rows FROM (
          SELECT gene, pathway, 1 AS l, 0 AS r FROM edges UNION ALL SELECT gene, pathway, 0, 1 FROM damaged
          UNION ALL SELECT gene, pathway, 0, 1 FROM damaged WHERE pathway IN (SELECT id FROM node WHERE taxon = 'PROMO'))
        GROUP BY gene, pathway HAVING sum(l) <> sum(r)""",
    "diff_counts": "SELECT change, count(*) AS nodes FROM changes GROUP BY change",
    "successors": "SELECT id, label, replaced_by FROM followers",
    "retired_rows": """
        SELECT c.id, c.previous_label AS label, 'V96' AS last_seen, 'V97' AS retired_in, f.replaced_by
        FROM changes c LEFT JOIN followers f ON f.id = c.id WHERE c.change = 'retired'""",
    "label_conflicts": """
        SELECT id, count(DISTINCT label) AS labels, min(label) AS first_label, max(label) AS last_label
        FROM faulty GROUP BY id HAVING count(DISTINCT label) > 1""",
    "label_keywords": "SELECT id, label FROM node WHERE contains(upper(label), 'RING') OR contains(label, 'old')",
    "nested_pairs": "SELECT child, parent, pairs FROM nested",
    "dangling_endpoints": "SELECT id FROM loose_ends",
    "missing_evidence": "SELECT gene, pathway, accession FROM facts WHERE code = 'N'",
    "unexpected_evidence": "SELECT code, count(*) AS facts FROM facts WHERE code NOT IN ('A', 'R') GROUP BY code",
    "taxon_cardinality": "SELECT id, taxa FROM taxa_found",
    "chk_taxon": listed("1. one taxon only", "faulty WHERE taxon <> 'GOOD'", "id", "no other taxon"),
    "chk_ids": listed(
        "2. ids carry the infix", "(SELECT 'R-MMU-' || p_partkey AS id FROM part WHERE p_size = 9)", "id", "no other id"
    ),
    "chk_cardinality": listed("3. exactly one taxon per node", "taxa_found", "id", "every node has one"),
    "chk_count": chk_count(2050),
    "chk_acyclic": listed("5. hierarchy is acyclic", "endless", "node", "no cycles"),
    "chk_endpoints": listed("6. no dangling endpoints", "loose_ends", "id", "every endpoint is a node"),
    "chk_evidence": EVIDENCE,
    "spot_check": "SELECT rows, has_required, keyword_labels, nested FROM spot",
    "chk_shapes": chk_shapes("damaged"),
    "chk_members": MEMBERS,
    "chk_total": chk_total(100_000, 1_000_000),
    "chk_terms": TERMS,
    "check_offenders": """
        SELECT "check", row_number() OVER (PARTITION BY "check" ORDER BY offender COLLATE "C")::INT AS place, offender, rows FROM (
          SELECT "check", offender, count(*) AS rows FROM (
            SELECT '1. one taxon only' AS "check", id AS offender FROM ended WHERE taxon <> 'GOOD'
            UNION ALL SELECT '2. ids carry the infix', id::VARCHAR FROM faulty WHERE NOT contains(id::VARCHAR, '1')
            UNION ALL SELECT '3. exactly one taxon per node', id FROM ended GROUP BY id HAVING count(DISTINCT taxon) <> 1
            UNION ALL SELECT '5. hierarchy is acyclic', node::VARCHAR FROM endless
            UNION ALL SELECT '6. no dangling endpoints', id::VARCHAR
              FROM (SELECT child AS id FROM cyclic UNION ALL SELECT parent FROM cyclic) WHERE id NOT IN (SELECT id FROM faulty)
            UNION ALL SELECT DISTINCT '7. evidence is the mapped set', code FROM facts WHERE code NOT IN ('A', 'R')
            UNION ALL SELECT '12. model terms are defined', term FROM usage WHERE term NOT IN (SELECT term FROM defined))
          GROUP BY "check", offender)
        QUALIFY place <= 20""",
    "acceptance": "\nUNION ALL ".join([
        listed("1. one taxon only", f"{ENTITIES} WHERE taxon <> 'PROMO'", "id", "no other taxon"),
        listed("2. ids carry the infix", "node WHERE NOT contains(id::VARCHAR, '1')", "id", "no other id"),
        listed("3. exactly one taxon per node", CARDINALITY, "id", "every node has one"),
        chk_count(2000),
        listed("5. hierarchy is acyclic", "(SELECT node FROM above WHERE node = ancestor)", "node", "no cycles"),
        listed("6. no dangling endpoints", "hierarchy WHERE child NOT IN (SELECT id FROM node) OR parent NOT IN (SELECT id FROM node)",
               "child", "every endpoint is a node"),
        EVIDENCE, SPOT, chk_shapes("edges"),
        MEMBERS,
        chk_total(1_000, 10_000_000_000), TERMS,
    ]),
    "characteristics": report(),
}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in SQL.items()}
