"""The same results in plain SQL, written against the test tables.

The statements are put together from named parts.  Each part states what its step means
row by row, with windows, subqueries and pair joins where the Spark side avoids them.
"""

from __future__ import annotations

# Fixed values, the same as on the Spark side.
RANKS = ["infraspecificEpithet", "specificEpithet", "genus", "family", '"order"', "class", "phylum", "kingdom"]
KINGDOMS = "('STANDARD', 'ECONOMY', 'PROMO', 'SMALL')"

PARTS: dict[str, str] = {}

PARTS["named_part"] = """
SELECT p_partkey, p_size, p_name, p_brand, p_type AS kingdom, p_brand AS phylum,
  split_part(p_name, ' ', 1) || ' ' || p_brand || suffix AS class,
  split_part(p_name, ' ', 2) || ' ' || p_brand || suffix AS "order",
  p_name || ' ' || p_brand || suffix AS family,
  split_part(p_name, ' ', 2) || ' ' || p_brand || suffix AS genus,
  CAST(p_size AS VARCHAR) AS specificEpithet,
  CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN CAST(p_partkey AS VARCHAR) END AS infraspecificEpithet
FROM (SELECT *, CASE WHEN p_partkey > 2000 THEN '-' || ((p_partkey - 1) // 2000) ELSE '' END AS suffix FROM part)"""

PARTS["raw"] = """
SELECT 'L-' || l_orderkey || '-' || l_linenumber AS "speciesId",
  '<i>' || p_name || '</i> ' || p_brand AS "taxonName",
  'x' AS "domain ",
  CASE WHEN l_linenumber > 1 OR l_returnflag <> 'R' THEN '  ' || phylum || ' ' END AS phylum,
  CASE WHEN l_linenumber >= 2 AND l_discount <> 0 THEN class END AS class,
  CASE WHEN l_linenumber >= 3 THEN "order" END AS "order",
  CASE WHEN l_linenumber >= 4 THEN family END AS family,
  CASE WHEN l_linenumber >= 5 AND l_tax <> 0.01 THEN ' ' || genus END AS genus,
  CASE WHEN l_linenumber >= 6
    THEN specificEpithet || CASE WHEN l_tax = 0.08 THEN 'x' ELSE '' END END AS species,
  CASE WHEN l_linenumber >= 7 THEN infraspecificEpithet END AS subspecies,
  l_returnflag AS "data cleanup changes", l_linestatus AS query, l_returnflag AS "Unnamed: 17",
  CAST(NULL AS VARCHAR) AS tribe
FROM lineitem JOIN named_part ON l_partkey = p_partkey"""

PARTS["trimmed"] = """
SELECT "speciesId", "taxonName", trim(phylum, ' ') AS phylum, trim(class, ' ') AS class,
  trim("order", ' ') AS "order", trim(family, ' ') AS family, trim(genus, ' ') AS genus,
  trim(species, ' ') AS specificEpithet, coalesce(trim(subspecies, ' '), '') AS infraspecificEpithet
FROM raw"""

PARTS["corrected"] = """
SELECT "speciesId", "taxonName", phylum, class, "order", family, genus, genus AS genericName,
  CASE WHEN genus = 'ring Brand#13' AND specificEpithet = '7' THEN '8'
       WHEN genus = 'bolt Brand#5' AND specificEpithet = '11x' THEN '11'
       WHEN genus = 'gear Brand#21' AND specificEpithet = '9' THEN '10'
       ELSE specificEpithet END AS specificEpithet,
  CASE WHEN genus = 'ring Brand#13' AND specificEpithet = '7' THEN '8'
       ELSE infraspecificEpithet END AS infraspecificEpithet
FROM trimmed"""

PARTS["cleaned"] = """
SELECT "speciesId", replace(replace("taxonName", '<i>', ''), '</i>', '') AS "taxonName",
  'Eukarya' AS domain, phylum, class, "order", family, genus, specificEpithet, infraspecificEpithet,
  genericName,
  CASE WHEN phylum IN ('Brand#1', 'Brand#2') THEN 'PROMO' WHEN phylum = 'Brand#3' THEN 'MEDIUM'
       WHEN phylum = 'Brand#4' THEN 'LARGE' ELSE 'STANDARD' END AS kingdom
FROM corrected"""

PARTS["grouped"] = """
SELECT CAST(grouping(kingdom) + grouping(phylum) + grouping(class) + grouping("order") + grouping(family)
    + grouping(genus) + grouping(specificEpithet) + grouping(infraspecificEpithet) AS BIGINT) AS absent,
  min(p_partkey) AS first_part, min(p_size) AS low, max(p_size) AS high,
  kingdom, phylum, class, "order", family, genus, specificEpithet, infraspecificEpithet
FROM named_part
GROUP BY GROUPING SETS ((kingdom), (kingdom, phylum), (kingdom, phylum, class),
  (kingdom, phylum, class, "order"), (kingdom, phylum, class, "order", family),
  (kingdom, phylum, class, "order", family, genus),
  (kingdom, phylum, class, "order", family, genus, specificEpithet),
  (kingdom, phylum, class, "order", family, genus, specificEpithet, infraspecificEpithet))"""

PARTS["backbone"] = """
SELECT first_part * 10 + absent AS taxonID,
  CASE WHEN low > 30 AND low <= 47 THEN (first_part - 1) * 10 + absent END AS acceptedNameUsageID,
  CASE WHEN high = 7 THEN 'unranked' WHEN absent = 0 THEN 'subspecies' WHEN absent = 1 THEN 'species'
       WHEN absent = 2 THEN 'genus' WHEN absent = 3 THEN 'family' WHEN absent = 4 THEN 'order'
       WHEN absent = 5 THEN 'class' WHEN absent = 6 THEN 'phylum' ELSE 'kingdom' END AS taxonRank,
  CASE WHEN low <= 30 THEN 'accepted' WHEN low <= 38 THEN 'synonym' WHEN low <= 42 THEN 'homotypic synonym'
       WHEN low <= 45 THEN 'heterotypic synonym' WHEN low <= 47 THEN 'proparte synonym'
       ELSE 'doubtful' END AS taxonomicStatus,
  CASE WHEN phylum IS NULL OR phylum NOT LIKE 'Brand#2%' THEN coalesce(genus || ' ' || specificEpithet,
       genus, family, "order", class, phylum, kingdom) END AS canonicalName,
  genus AS genericName,
  kingdom, phylum, class, "order", family, genus, specificEpithet, infraspecificEpithet
FROM grouped WHERE absent > 0 OR infraspecificEpithet IS NOT NULL"""

PARTS["prepared"] = """
SELECT taxonID, genericName, genus, specificEpithet,
  coalesce(infraspecificEpithet, '') AS infraspecificEpithet, taxonomicStatus, acceptedNameUsageID
FROM backbone
WHERE taxonRank <> 'unranked' AND genus <> '' AND specificEpithet <> ''
  AND taxonomicStatus IN ('accepted', 'synonym', 'homotypic synonym', 'proparte synonym', 'heterotypic synonym')"""

PARTS["matching"] = """
SELECT c."speciesId" AS speciesID, p.taxonID AS matched_taxonID, p.acceptedNameUsageID,
  c."taxonName", c.domain, c.kingdom, c.phylum, c.class, c."order", c.family, c.genus, p.genericName,
  c.specificEpithet, nullif(c.infraspecificEpithet, '') AS infraspecificEpithet,
  count(*) OVER (PARTITION BY c."speciesId") AS n_rows
FROM cleaned c LEFT JOIN prepared p ON c.genus = p.genus AND c.specificEpithet = p.specificEpithet
  AND c.infraspecificEpithet = p.infraspecificEpithet"""

PARTS["unmatched"] = """
SELECT speciesID, "taxonName", domain, kingdom, coalesce(phylum, '') AS phylum, coalesce(class, '') AS class,
  coalesce("order", '') AS "order", coalesce(family, '') AS family,
  coalesce(CASE WHEN genus IS NULL AND specificEpithet IS NOT NULL THEN split_part("taxonName", ' ', 1)
           ELSE genus END, '') AS genus,
  coalesce(specificEpithet, '') AS specificEpithet, coalesce(infraspecificEpithet, '') AS infraspecificEpithet
FROM matching WHERE n_rows = 1 AND matched_taxonID IS NULL"""

PARTS["names"] = f"""
SELECT taxonID, canonicalName, {', '.join(f"coalesce({r}, '') AS {r}" for r in RANKS)}
FROM backbone
WHERE taxonomicStatus = 'accepted' AND kingdom IN {KINGDOMS} AND canonicalName <> ''"""

PARTS["groups"] = """
SELECT * FROM (
  SELECT *, count(*) OVER (PARTITION BY canonicalName) AS n_nodes,
    row_number() OVER (PARTITION BY canonicalName ORDER BY taxonID) AS place
  FROM names) numbered WHERE n_nodes > 1"""

_LONG_RANKS = [r.strip('"') for r in RANKS]

# One row per node and rank: its value there, and whether the next finer rank is empty.
PARTS["ranked"] = " UNION ALL ".join(
    f"SELECT canonicalName, taxonID, {i} AS prio, '{_LONG_RANKS[i]}' AS rank, {r} AS value, "
    + ("FALSE" if i == 0 else f"{RANKS[i - 1]} = ''")
    + " AS open FROM groups"
    for i, r in enumerate(RANKS)
)

PARTS["usable"] = "SELECT DISTINCT canonicalName FROM ranked WHERE value = canonicalName"

PARTS["picks"] = """
SELECT c.canonicalName, c.rank, c.chosen_id,
  CASE WHEN c.chosen_id = a.taxonID THEN b.taxonID ELSE a.taxonID END AS other_id
FROM (SELECT canonicalName, rank, min(taxonID) AS chosen_id FROM ranked WHERE open GROUP BY 1, 2) c
JOIN usable u ON u.canonicalName = c.canonicalName
JOIN groups a ON a.canonicalName = c.canonicalName AND a.place = 1
JOIN groups b ON b.canonicalName = c.canonicalName AND b.place = 2"""


def _targets(source: str) -> str:
    rank = " ".join(f"WHEN {r} <> '' THEN '{n}'" for r, n in zip(RANKS, _LONG_RANKS))
    name = ", ".join(f"nullif({r}, '')" for r in RANKS)
    return f"SELECT *, CASE {rank} END AS lowest_rank, coalesce({name}) AS lowest_name FROM {source}"


_SIX = ["class", '"order"', "family", "genus", "specificEpithet", "infraspecificEpithet"]


def _assigned(targets: str) -> str:
    chosen = " AND ".join(f"t.{c} = n.{c}" for c in _SIX)
    other = " AND ".join(f"t.{c} = o.{c}" for c in _SIX)
    return f"""
SELECT t.*, CASE WHEN t.lowest_rank = 'genus' AND t.n_same = 1 AND NOT ({chosen}) AND ({other})
    THEN p.other_id ELSE p.chosen_id END AS parent
FROM (SELECT *, count(*) OVER (PARTITION BY lowest_rank, lowest_name) AS n_same FROM {targets}) t
JOIN picks p ON p.canonicalName = t.lowest_name AND p.rank = t.lowest_rank
JOIN names n ON n.taxonID = p.chosen_id JOIN names o ON o.taxonID = p.other_id"""


PARTS["targets"] = _targets("unmatched")
PARTS["first_stage"] = _assigned("targets")
PARTS["waiting"] = """
SELECT u.* FROM unmatched u WHERE NOT EXISTS (SELECT 1 FROM first_stage f WHERE f.speciesID = u.speciesID)"""

PARTS["supplier_records"] = """
SELECT s_suppkey AS record_id, kingdom, phylum, class, "order", family, genus,
  '' AS specificEpithet, '' AS infraspecificEpithet
FROM supplier JOIN named_part ON s_suppkey = p_partkey"""
PARTS["supplier_targets"] = _targets("supplier_records")
PARTS["supplier_first"] = _assigned("supplier_targets")

PARTS["filled"] = """
SELECT "speciesId" AS speciesID, "taxonName", kingdom, coalesce(phylum, '') AS phylum,
  coalesce(class, '') AS class, coalesce("order", '') AS "order", coalesce(family, '') AS family,
  coalesce(genus, '') AS genus, coalesce(specificEpithet, '') AS specificEpithet, infraspecificEpithet
FROM cleaned"""

PARTS["rank_nodes"] = f"""
SELECT taxonID, taxonRank, {', '.join(RANKS)} FROM backbone
WHERE taxonomicStatus = 'accepted' AND taxonRank <> 'unranked' AND kingdom IN {KINGDOMS}"""


# level: (record condition, node condition, join keys)
_LEVELS = {
    "phylum": (
        "r.phylum <> '' AND r.class = '' AND r.\"order\" = '' AND r.family = '' AND r.genus = ''"
        " AND r.specificEpithet = '' AND r.infraspecificEpithet = ''",
        'n.class IS NULL AND n."order" IS NULL AND n.family IS NULL AND n.genus IS NULL'
        " AND n.specificEpithet IS NULL AND n.infraspecificEpithet IS NULL",
        ["phylum"],
    ),
    "class": (
        "r.class <> '' AND r.\"order\" = '' AND r.family = '' AND r.genus = ''"
        " AND r.specificEpithet = '' AND r.infraspecificEpithet = ''",
        'n."order" IS NULL AND n.family IS NULL AND n.genus IS NULL'
        " AND n.specificEpithet IS NULL AND n.infraspecificEpithet IS NULL",
        ["class"],
    ),
    "order": (
        "r.class <> '' AND r.\"order\" <> '' AND r.family = '' AND r.genus = ''"
        " AND r.specificEpithet = '' AND r.infraspecificEpithet = ''",
        "n.family IS NULL AND n.genus IS NULL AND n.specificEpithet IS NULL AND n.infraspecificEpithet IS NULL",
        ['"order"'],
    ),
    "family": (
        "r.class <> '' AND r.\"order\" <> '' AND r.family <> '' AND r.genus = ''"
        " AND r.specificEpithet = '' AND r.infraspecificEpithet = ''",
        "n.genus IS NULL AND n.specificEpithet IS NULL AND n.infraspecificEpithet IS NULL"
        ' AND n."order" IN (SELECT r."order" FROM {source} r WHERE {mask})',
        ["family"],
    ),
    "genus": (
        "r.class <> '' AND r.\"order\" <> '' AND r.family <> '' AND r.genus <> ''"
        " AND r.specificEpithet = '' AND r.infraspecificEpithet = ''",
        "n.taxonRank <> 'species' AND n.specificEpithet IS NULL AND n.infraspecificEpithet IS NULL",
        ["genus"],
    ),
    "specificEpithet": (
        "r.class <> '' AND r.\"order\" <> '' AND r.family <> '' AND r.genus <> ''"
        " AND r.specificEpithet <> '' AND r.infraspecificEpithet = ''",
        "n.infraspecificEpithet IS NOT NULL",
        ["specificEpithet", "genus"],
    ),
    "infraspecificEpithet": (
        "r.class <> '' AND r.\"order\" <> '' AND r.family <> '' AND r.genus <> '' AND r.infraspecificEpithet <> ''",
        "TRUE",
        ["infraspecificEpithet", "genus"],
    ),
}


def _level_pairs(source: str, record_id: str, levels: list[str] | None = None, extra: str = "") -> str:
    """All (record, parent) pairs of the levels."""
    selects = []
    for level in levels or list(_LEVELS):
        mask, condition, keys = _LEVELS[level]
        condition = condition.format(source=source, mask=mask)
        on = " AND ".join(f"r.{k} = n.{k}" for k in keys)
        selects.append(
            f"SELECT r.{record_id}, '{level}' AS level, {', '.join('r.' + k for k in dict.fromkeys(RANKS))},"
            f" n.taxonID AS parent FROM {source} r JOIN rank_nodes n ON {on}{extra} WHERE {mask} AND {condition}"
        )
    return " UNION ALL ".join(selects)


PARTS["second_pairs"] = _level_pairs("waiting", "speciesID")
PARTS["second_stage"] = """
SELECT speciesID, level, count(*) AS n_parents, min(parent) AS parent FROM second_pairs GROUP BY speciesID, level"""

PARTS["second_full"] = """
SELECT w.*, p.parent FROM waiting w JOIN second_pairs p ON p.speciesID = w.speciesID"""

PARTS["assigned"] = """
SELECT u.*,
  CASE WHEN f.speciesID IS NOT NULL THEN 'first' WHEN s.speciesID IS NOT NULL THEN 'second'
       ELSE 'none' END AS stage,
  CASE WHEN f.speciesID IS NOT NULL THEN 1 ELSE coalesce(s.n_parents, 0) END AS n_parents,
  coalesce(f.parent, s.parent) AS parentNameUsageID
FROM unmatched u LEFT JOIN first_stage f ON f.speciesID = u.speciesID
  LEFT JOIN second_stage s ON s.speciesID = u.speciesID"""

# Which parts a part reads, in the order they have to be written.
_NEEDS = {
    "raw": ["named_part"],
    "trimmed": ["raw"],
    "corrected": ["trimmed"],
    "cleaned": ["corrected"],
    "filled": ["cleaned"],
    "grouped": ["named_part"],
    "backbone": ["grouped"],
    "prepared": ["backbone"],
    "matching": ["cleaned", "prepared"],
    "unmatched": ["matching"],
    "names": ["backbone"],
    "groups": ["names"],
    "ranked": ["groups"],
    "usable": ["ranked"],
    "picks": ["usable", "groups"],
    "targets": ["unmatched"],
    "first_stage": ["targets", "picks", "names"],
    "waiting": ["unmatched", "first_stage"],
    "rank_nodes": ["backbone"],
    "second_pairs": ["waiting", "rank_nodes"],
    "second_stage": ["second_pairs"],
    "second_full": ["waiting", "second_pairs"],
    "assigned": ["unmatched", "first_stage", "second_stage"],
    "supplier_records": ["named_part"],
    "supplier_targets": ["supplier_records"],
    "supplier_first": ["supplier_targets", "picks", "names"],
}


def _with(select: str, *parts: str) -> str:
    """``select`` preceded by the parts it reads and the parts those read."""
    order: list[str] = []

    def add(part: str) -> None:
        for need in _NEEDS.get(part, []):
            add(need)
        if part not in order:
            order.append(part)

    for part in parts:
        add(part)
    return "WITH " + ",\n".join(f"{p} AS MATERIALIZED ({PARTS[p]})" for p in order) + "\n" + select


_PAIR = (
    "speciesID, matched_taxonID, acceptedNameUsageID, kingdom, genus, genericName, specificEpithet,"
    " infraspecificEpithet"
)
_COUNTED = """
SELECT c."speciesId" AS speciesID, c.kingdom, c.genus, c.specificEpithet, c.infraspecificEpithet,
  count(*) OVER (PARTITION BY c."speciesId") > 1 AS is_repeated, coalesce(p.n, 0) AS n_nodes,
  p.matched_taxonID, p.acceptedNameUsageID, p.genericName
FROM cleaned c LEFT JOIN (
  SELECT genus, specificEpithet, infraspecificEpithet, count(*) AS n,
    CASE WHEN count(*) = 1 THEN min(taxonID) END AS matched_taxonID,
    CASE WHEN count(*) = 1 THEN min(acceptedNameUsageID) END AS acceptedNameUsageID,
    CASE WHEN count(*) = 1 THEN min(genericName) END AS genericName
  FROM prepared GROUP BY genus, specificEpithet, infraspecificEpithet) p
ON c.genus = p.genus AND c.specificEpithet = p.specificEpithet
  AND c.infraspecificEpithet = p.infraspecificEpithet"""

# Columns of a full output record; ranks the derived checklist does not have are ''.
_OUTPUT = """speciesID, CAST(NULL AS BIGINT) AS "matched_taxonID", CAST(NULL AS BIGINT) AS "acceptedNameUsageID",
  "taxonName", domain, kingdom, phylum, class, '' AS subclass, '' AS superorder, "order", '' AS "sub-order",
  '' AS infraorder, '' AS section, '' AS subsection, '' AS superfamily, family, '' AS subfamily, '' AS tribe,
  genus, '' AS subgenus, '' AS "genericName", specificEpithet, infraspecificEpithet,
  'BOSuncornirmedSpecies' AS "taxonRank", 'BOSunformired' AS "taxonomicStatus",
  CAST(NULL AS BIGINT) AS "parentNameUsageID" """



def _output(parent: str) -> str:
    """The columns of a full output record that has the parent ``parent``."""
    return _OUTPUT.replace('CAST(NULL AS BIGINT) AS "parentNameUsageID"', f'{parent} AS "parentNameUsageID"')


_RAW_COLUMNS = [
    "speciesId", "taxonName", "domain ", "phylum", "class", "order", "family", "genus", "species", "subspecies",
    "data cleanup changes", "query", "Unnamed: 17", "tribe",
]

ORACLE: dict[str, str] = {
    "q_clean_trim": """SELECT doc_id, trim('  ' || text || ' ', ' ') AS text, trim(source || '  ', ' ') AS source
FROM documents""",
    "q_strip_markup": """SELECT page_id, replace(replace(replace(replace(html, '<p>', '<i>'), '</p>', '</i>'),
  '<i>', ''), '</i>', '') AS html FROM pages""",
    "q_clean_rename": "SELECT c_custkey AS record_id, c_name AS genus, c_name AS genericName, c_mktsegment FROM customer",
    "q_clean_drop": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "q_profile_nulls": _with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count(*) FILTER (\"{c}\" IS NULL) AS len FROM raw" for c in _RAW_COLUMNS
        ),
        "raw",
    ),
    "q_drop_all_null": _with("SELECT " + ", ".join(f'"{c}"' for c in _RAW_COLUMNS[:-1]) + " FROM raw", "raw"),
    "q_correct": _with(
        'SELECT "speciesId", genericName, specificEpithet, infraspecificEpithet FROM corrected', "corrected"
    ),
    "q_correct_table": _with(
        """SELECT c."speciesId", c.genus, coalesce(r.corrected, c.specificEpithet) AS specificEpithet
FROM cleaned c LEFT JOIN (
  SELECT genus, specificEpithet || 'x' AS found, min(specificEpithet) AS corrected FROM backbone
  WHERE infraspecificEpithet IS NULL AND specificEpithet IS NOT NULL GROUP BY 1, 2) r
ON c.genus = r.genus AND c.specificEpithet = r.found""",
        "cleaned",
        "backbone",
    ),
    "q_map_category": """SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'goods'
  WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'home' ELSE 'other' END AS kind FROM customer""",
    "q_null_normalise": _with(
        """SELECT taxonID, acceptedNameUsageID, coalesce(canonicalName, '') AS canonicalName,
  coalesce(family, '') AS family, coalesce(genus, '') AS genus,
  nullif(coalesce(specificEpithet, ''), '') AS specificEpithet,
  nullif(coalesce(infraspecificEpithet, ''), '') AS infraspecificEpithet FROM backbone""",
        "backbone",
    ),
    "q_cast_ids": """SELECT o_orderkey AS order_id, try_cast(o_orderstatus || o_custkey AS BIGINT) AS mixed_id
FROM orders""",
    "q_derive_token": _with(
        """SELECT "speciesId", "taxonName", CASE WHEN genus IS NULL AND specificEpithet IS NOT NULL
  THEN split_part("taxonName", ' ', 1) ELSE genus END AS genus, split_part("taxonName", ' ', 1) AS token
FROM cleaned""",
        "cleaned",
    ),
    "q_clean_records": _with("SELECT * FROM cleaned", "cleaned"),
    "q_backbone_prepare": _with("SELECT * FROM prepared", "prepared"),
    "q_backbone_generic": _with(
        """SELECT taxonID, genericName, CASE WHEN taxonID % 3 <> 0 THEN genus ELSE genericName END AS genus,
  specificEpithet, coalesce(infraspecificEpithet, '') AS infraspecificEpithet, taxonomicStatus, acceptedNameUsageID
FROM backbone
WHERE taxonRank <> 'unranked' AND CASE WHEN taxonID % 3 <> 0 THEN genus ELSE genericName END <> ''
  AND specificEpithet <> ''
  AND taxonomicStatus IN ('accepted', 'synonym', 'homotypic synonym', 'proparte synonym', 'heterotypic synonym')""",
        "backbone",
    ),
    "q_exact_match": _with(f"SELECT {_PAIR} FROM matching", "matching"),
    "q_exact_record_name": _with(
        """SELECT c."speciesId" AS speciesID, p.taxonID AS matched_taxonID, p.acceptedNameUsageID, c.kingdom, c.genus,
  c.genericName, c.specificEpithet, nullif(c.infraspecificEpithet, '') AS infraspecificEpithet
FROM cleaned c LEFT JOIN prepared p ON c.genus = p.genus AND c.specificEpithet = p.specificEpithet
  AND c.infraspecificEpithet = p.infraspecificEpithet""",
        "cleaned",
        "prepared",
    ),
    "q_ambiguous_rows": _with(f"SELECT {_PAIR} FROM matching WHERE n_rows > 1", "matching"),
    "q_backed_left": _with(
        f"""SELECT {_PAIR} FROM matching WHERE n_rows > 1 AND speciesID NOT IN (
  SELECT speciesID FROM matching WHERE n_rows > 1 AND acceptedNameUsageID IS NULL AND matched_taxonID IN (
    SELECT acceptedNameUsageID FROM matching
    WHERE n_rows > 1 AND matched_taxonID IS NOT NULL AND acceptedNameUsageID IS NOT NULL))""",
        "matching",
    ),
    "q_exact_candidates": _with(
        f"""SELECT speciesID, matched_taxonID, acceptedNameUsageID, kingdom, genus, genericName, specificEpithet,
  nullif(infraspecificEpithet, '') AS infraspecificEpithet, n_nodes, is_repeated FROM ({_COUNTED})""",
        "cleaned",
        "prepared",
    ),
    "q_unique_only": _with(f"SELECT {_PAIR} FROM matching WHERE n_rows = 1", "matching"),
    "q_unique_matches": _with(
        f"SELECT {_PAIR} FROM matching WHERE n_rows = 1 AND matched_taxonID IS NOT NULL", "matching"
    ),
    "q_ambiguous": _with(
        f"SELECT speciesID, genus, n_nodes, is_repeated FROM ({_COUNTED}) WHERE n_nodes > 1 OR is_repeated",
        "cleaned",
        "prepared",
    ),
    "q_duplicates_only": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""",
    "q_accepted_backed": _with(
        f"""SELECT speciesID, genus, specificEpithet, infraspecificEpithet, n_nodes, count(*) AS n_backed,
  min(taxonID) AS first_backed
FROM (
  SELECT a.row_no, a.speciesID, a.genus, a.specificEpithet, a.infraspecificEpithet, a.n_nodes, p.taxonID
  FROM (SELECT *, row_number() OVER () AS row_no FROM ({_COUNTED}) WHERE n_nodes > 1 OR is_repeated) a
  JOIN prepared p ON a.genus = p.genus AND a.specificEpithet = p.specificEpithet
    AND a.infraspecificEpithet = p.infraspecificEpithet
  WHERE p.acceptedNameUsageID IS NULL
    AND p.taxonID IN (SELECT acceptedNameUsageID FROM matching WHERE n_rows > 1))
GROUP BY row_no, speciesID, genus, specificEpithet, infraspecificEpithet, n_nodes""",
        "matching",
    ),
    "q_accepted_backed_pairs": _with(
        f"""SELECT {_PAIR} FROM (SELECT m.*, b.backing FROM matching m LEFT JOIN (
  SELECT DISTINCT acceptedNameUsageID AS backing FROM matching
  WHERE n_rows > 1 AND acceptedNameUsageID IS NOT NULL) b ON b.backing = m.matched_taxonID)
WHERE n_rows = 1 OR (acceptedNameUsageID IS NULL AND backing IS NOT NULL)""",
        "matching",
    ),
    "q_no_match": _with(f"SELECT {_OUTPUT} FROM unmatched", "unmatched"),
    "q_distinct": "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",
    "q_semi": """SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders
  WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
    "q_anti": """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders
  WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
    "q_homonyms": _with(
        "SELECT canonicalName, taxonID, kingdom, phylum, genus FROM groups ORDER BY canonicalName, taxonID", "groups"
    ),
    "q_homonym_features": _with(
        """SELECT canonicalName, string_agg(rank, ', ' ORDER BY prio) AS features_text, count(*) AS n_features
FROM (SELECT DISTINCT canonicalName, prio, rank FROM ranked WHERE value = canonicalName) GROUP BY canonicalName""",
        "ranked",
    ),
    "q_homonym_pick": _with("SELECT canonicalName, rank, chosen_id, other_id FROM picks", "picks"),
    "q_homonym_assign": _with(
        """SELECT speciesID, genus, family, "order", class, phylum, kingdom, parent AS "parentNameUsageID"
FROM first_stage""",
        "first_stage",
    ),
    "q_homonym_tiebreak": _with(
        'SELECT record_id, family, genus, parent AS "parentNameUsageID" FROM supplier_first', "supplier_first"
    ),
    "q_unresolvable": _with(
        """SELECT lowest_rank, lowest_name, count(*) AS n_records FROM targets t
WHERE lowest_name IN (SELECT canonicalName FROM usable) AND NOT EXISTS (
  SELECT 1 FROM picks p WHERE p.canonicalName = t.lowest_name AND p.rank = t.lowest_rank)
GROUP BY 1, 2""",
        "targets",
        "picks",
    ).replace("AND canonicalName <> ''", "AND canonicalName <> '' AND taxonRank <> 'order'"),
    "q_lowest_rank": _with(
        "SELECT speciesID, lowest_rank, lowest_name FROM (" + _targets("filled") + ")", "filled"
    ),
    "q_presence_mask": _with(
        "SELECT speciesID, level, "
        + "CASE level "
        + " ".join(f"WHEN '{v}' THEN {k[2][0]}" for v, k in _LEVELS.items())
        + " END AS level_name, CASE level "
        + " ".join(f"WHEN '{v}' THEN {k[2][1] if len(k[2]) > 1 else chr(39) * 2}" for v, k in _LEVELS.items())
        + " END AS level_second FROM (SELECT r.*, CASE "
        + " ".join(f"WHEN {k[0]} THEN '{v}'" for v, k in _LEVELS.items())
        + " END AS level FROM filled r)",
        "filled",
    ),
    "q_unmatched_names": _with(
        " UNION ALL ".join(
            f"SELECT '{v}' AS level, r.{k[2][0]} AS level_name, "
            + (f"r.{k[2][1]}" if len(k[2]) > 1 else "''")
            + f" AS level_second, count(*) AS n_records FROM filled r WHERE {k[0]} GROUP BY 1, 2, 3"
            for v, k in _LEVELS.items()
        ),
        "filled",
    ),
    "q_rank_backbone": _with("SELECT * FROM rank_nodes", "rank_nodes"),
    "q_rank_match_pairs": _with(
        'SELECT speciesID, level, parent AS "parentNameUsageID" FROM ('
        + _level_pairs("filled", "speciesID")
        + ")",
        "filled",
        "rank_nodes",
    ),
    "q_second_stage": _with(
        'SELECT speciesID, level, n_parents, parent AS "parentNameUsageID" FROM second_stage', "second_stage"
    ),
    "q_all_matches": _with(
        f"""SELECT speciesID, "taxonName", {', '.join(RANKS)}, stage, n_parents, "parentNameUsageID"
FROM assigned WHERE stage <> 'none'""",
        "assigned",
    ),
    "q_remainder": _with(
        f"SELECT {_OUTPUT} FROM (SELECT * EXCLUDE (\"parentNameUsageID\") FROM assigned WHERE stage = 'none')", "assigned"
    ),
    "q_summary": _with(
        """SELECT stage, count(*) AS n_rows, CAST(sum(n_parents) AS BIGINT) AS n_parents,
  count(DISTINCT speciesID) AS n_records FROM assigned GROUP BY stage""",
        "assigned",
    ),
    "q_reconcile": _with(
        """SELECT 'unmatched' AS stage, count(*) AS n_rows, count(DISTINCT speciesID) AS n_records FROM unmatched
UNION ALL SELECT 'first_matches', count(*), count(DISTINCT speciesID) FROM first_stage
UNION ALL SELECT 'second_matches', count(*), count(DISTINCT speciesID) FROM second_stage
UNION ALL SELECT 'all_matches', count(*), count(DISTINCT speciesID) FROM (
  SELECT speciesID FROM first_stage UNION ALL SELECT speciesID FROM second_stage)
UNION ALL SELECT 'remainder', count(*), count(DISTINCT speciesID) FROM (
  SELECT speciesID FROM waiting WHERE speciesID NOT IN (SELECT speciesID FROM second_stage))""",
        "first_stage",
        "second_stage",
    ),
    "q_checklist_second": _with(f"SELECT {_output('parent')} FROM second_full", "second_full"),
    "q_checklist_all": _with(
        f"SELECT {_output('parent')} FROM second_full UNION ALL SELECT {_output('parent')} FROM first_stage",
        "first_stage",
        "second_full",
    ),
    "q_checklist_remainder": _with(
        f"SELECT {_OUTPUT} FROM waiting WHERE speciesID NOT IN (SELECT speciesID FROM second_stage)",
        "waiting",
        "second_stage",
    ),
    "q_checklist_backed": _with(
        f"SELECT {_PAIR} FROM matching m WHERE (n_rows = 1 AND matched_taxonID IS NOT NULL)"
        " OR (n_rows > 1 AND acceptedNameUsageID IS NULL AND EXISTS (SELECT 1 FROM"
        " (SELECT DISTINCT acceptedNameUsageID AS backing FROM matching WHERE n_rows > 1) b"
        " WHERE b.backing = m.matched_taxonID))",
        "matching",
    ),
    "q_checklist_summary": _with(
        " UNION ALL ".join(
            f"SELECT '{stage}' AS stage, count(*) AS n_rows, count(DISTINCT speciesID) AS n_records FROM {source}"
            for stage, source in (
                ("unmatched", "unmatched"),
                ("first_matches", "first_stage"),
                ("second_matches_phylum", "second_pairs WHERE level = 'phylum'"),
                ("second_matches_genus", "second_pairs WHERE level = 'genus'"),
                ("second_matches", "second_pairs"),
                ("all_matches", "(SELECT speciesID FROM first_stage UNION ALL SELECT speciesID FROM second_pairs)"),
                ("remainder", "waiting WHERE speciesID NOT IN (SELECT speciesID FROM second_stage)"),
            )
        ),
        "first_stage",
        "second_stage",
    ),
    "q_inspect": _with(
        f"""SELECT speciesID, "taxonName", "parentNameUsageID", {', '.join(RANKS)} FROM assigned
WHERE phylum = 'Brand#21' ORDER BY "parentNameUsageID", speciesID""",
        "assigned",
    ),
}

# Records of one level can repeat an id, so parents are counted per record row.
_ROWS = "SELECT row_number() OVER () AS row_no, * FROM filled"


def _counted_level(levels: list[str] | None, keys: list[str], extra: str = "") -> str:
    pairs = _level_pairs("rows", "row_no", levels, extra)
    columns = ", ".join(f"r.{k}" for k in keys)
    return (
        _with("", "filled", "rank_nodes").rstrip()
        + f",\nrows AS ({_ROWS}), pairs AS ({pairs})\n"
        + f"SELECT r.speciesID, {columns}{', ' if columns else ''}"
        + ("p.level, " if not keys else "")
        + "count(*) AS n_parents, min(p.parent) AS first_parent FROM rows r JOIN pairs p ON p.row_no = r.row_no"
        + f" GROUP BY r.row_no, r.speciesID, {columns if keys else 'p.level'}"
    )


for _level, (_, _, _keys) in _LEVELS.items():
    ORACLE[f"q_rank_match_{_level.lower()}"] = _counted_level([_level], _keys)
ORACLE["q_rank_match_kingdom"] = _counted_level(None, [], " AND r.kingdom = n.kingdom")

ORACLE["q_rank_match_grid"] = ORACLE["q_rank_match_pairs"]

ORACLE["q_read_records"] = _with(
    """SELECT *, CASE WHEN query = 'F' THEN coalesce(subspecies, '') END AS log FROM raw""", "raw"
)

_BACKBONE_COLUMNS = ["taxonID", "acceptedNameUsageID", "taxonRank", "taxonomicStatus", "canonicalName", "genericName"]
_BACKBONE_COLUMNS += ["kingdom", "phylum", "class", '"order"', "family", "genus", "specificEpithet", "infraspecificEpithet"]

ORACLE["q_read_backbone"] = _with("SELECT * FROM backbone WHERE taxonID % 97 <> 0 AND taxonID % 89 <> 0", "backbone")
ORACLE["q_read_rejects"] = _with(
    "SELECT "
    + " || chr(9) || ".join(
        f"coalesce(CAST({c} AS VARCHAR), '')"
        if c != "acceptedNameUsageID"
        else f"CASE WHEN taxonID % 89 = 0 THEN 'none' ELSE coalesce(CAST({c} AS VARCHAR), '') END"
        for c in _BACKBONE_COLUMNS
    )
    + " || CASE WHEN taxonID % 97 = 0 THEN chr(9) || 'surplus' ELSE '' END AS line,"
    " CASE WHEN taxonID % 97 = 0 THEN 'columns' ELSE 'id acceptedNameUsageID' END AS reason"
    " FROM backbone WHERE taxonID % 97 = 0 OR taxonID % 89 = 0",
    "backbone",
)

_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_WHOLE, _NUMBER = "[+-]?[0-9]+", "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
ORACLE["q_infer_schema"] = (
    "SELECT *, CASE WHEN n_values > 0 AND n_long = n_values THEN 'long' WHEN n_values > 0 AND n_double = n_values"
    " THEN 'double' ELSE 'string' END AS type FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS n_values,"
        f" count(*) FILTER (regexp_full_match(CAST({c} AS VARCHAR), '{_WHOLE}') AND TRY_CAST({c} AS BIGINT) IS NOT NULL)"
        f" AS n_long, count(*) FILTER (regexp_full_match(CAST({c} AS VARCHAR), '{_NUMBER}')) AS n_double FROM lineitem"
        for c in _LINE_COLUMNS
    )
    + ")"
)

_LEVELED = "(SELECT w.*, p.parent, p.level FROM waiting w JOIN second_pairs p ON p.speciesID = w.speciesID)"
ORACLE["q_written_results"] = _with(
    " UNION ALL ".join(
        f"SELECT '{name}' AS result, {_output(parent)} FROM {source}"
        for name, parent, source in (
            ("first_matches", "parent", "first_stage"),
            ("second_matches_phylum", "parent", f"{_LEVELED} WHERE level = 'phylum'"),
            ("second_matches_genus", "parent", f"{_LEVELED} WHERE level = 'genus'"),
            ("second_matches", "parent", "second_full"),
            ("all_matches", "parent", "second_full"),
            ("all_matches", "parent", "first_stage"),
            ("remainder", "CAST(NULL AS BIGINT)", "waiting WHERE speciesID NOT IN (SELECT speciesID FROM second_stage)"),
        )
    ),
    "first_stage",
    "second_full",
    "second_stage",
)

ORACLE["q_semi_filtered"] = """SELECT l_partkey AS p_partkey, l_orderkey, l_linenumber FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand LIKE 'Brand#2%')"""
