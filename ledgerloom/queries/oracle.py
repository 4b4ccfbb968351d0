"""The SQL twin of every registered query, for DuckDB on the same tables.

Written apart from the Spark side: the stand-in views are common table expressions here,
and results are defined by joins, windows and groupings of plain SQL.
"""

from __future__ import annotations

import re

from ledgerloom import fixed_values as fixed

SHARE = """CASE WHEN o_orderpriority = '2-HIGH' THEN NULL
     WHEN o_orderpriority = '3-MEDIUM' THEN '40'
     WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN '0'
     WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'n/a'
     ELSE '100' END"""

IDENTIFIER = "CASE WHEN {0} % 3 = 0 THEN {0}::varchar || ' ' ELSE {0}::varchar END"

LINE_ORDER = "(l_linenumber::bigint << 40) + l_partkey"


def _values(block: str) -> str:
    rows = ", ".join("('{}', '{}')".format(*(p.replace("'", "''") for p in pair)) for pair in fixed.pairs(block))
    return f"SELECT * FROM (VALUES {rows}) v(code, label)"


def _list(items: list[str]) -> str:
    return ", ".join("'{}'".format(i.replace("'", "''")) for i in items)


def _mentions(column: str, names: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{n.lower()}')" for n in (m.replace("'", "''") for m in names)) + ")"


VIEWS = {
    "a_act": """
SELECT o_orderkey AS ord, o_orderkey::varchar AS aid,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Agence' WHEN 'FURNITURE' THEN 'Red Cross'
    WHEN 'HOUSEHOLD' THEN 'World Bank' WHEN 'MACHINERY' THEN 'Ministry' END || ' ' || n_name AS reporting,
  CASE n_regionkey WHEN 0 THEN 'FR' WHEN 1 THEN 'us' WHEN 2 THEN 'XM-DAC' WHEN 3 THEN 'JP' ELSE 'ZZ' END
    || '-' || c_custkey::varchar AS reporting_ref,
  'Order ' || o_orderkey::varchar AS title,
  o_orderpriority || ' / ' || c_name AS description,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 'ORD-' || o_orderkey::varchar END AS slug,
  CASE o_orderstatus WHEN 'O' THEN '2' WHEN 'F' THEN '4' ELSE 'x' END AS status_code,
  date_diff('day', date '1970-01-01', o_orderdate::date) AS day_start,
  CASE WHEN o_orderstatus = 'F' THEN date_diff('day', date '1970-01-01', o_orderdate::date) + 100 END AS day_end
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "a_fr": """
SELECT o_orderkey::varchar AS aid,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN 'Commande ' || o_orderkey::varchar END AS title,
  'Commande de priorité ' || o_orderpriority AS description
FROM orders WHERE o_totalprice > 250000""",
    "a_country": f"""
SELECT o_orderkey::varchar AS aid, 'KM' AS country_code, {SHARE} AS country_percent FROM orders
UNION ALL
SELECT o_orderkey::varchar, 'XX', '60' FROM orders WHERE o_orderpriority = '3-MEDIUM'""",
    "a_share": """
SELECT aid, coalesce(try_cast(country_percent AS double), 100) AS share
FROM a_country WHERE country_code = 'KM' AND coalesce(try_cast(country_percent AS double), 100) > 0""",
    "a_trans": f"""
SELECT {LINE_ORDER} AS ord, l_orderkey::varchar AS aid,
  CASE WHEN l_tax < 0.08 THEN year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) END AS trans_day,
  CASE WHEN l_quantity < 50 THEN l_extendedprice END AS trans_usd,
  CASE WHEN l_quantity < 50 THEN l_extendedprice / 1.0823 END AS trans_eur,
  CASE l_returnflag WHEN 'A' THEN 'D' WHEN 'N' THEN 'E' WHEN 'R' THEN 'C' END AS trans_code,
  CASE l_linestatus WHEN 'O' THEN '10' ELSE '99' END AS flow,
  CASE l_linenumber WHEN 1 THEN '110' WHEN 2 THEN '421' WHEN 3 THEN '510' WHEN 4 THEN '110' END AS fin
FROM lineitem""",
    "a_sector0": f"""
SELECT {LINE_ORDER} AS ord, l_orderkey::varchar AS aid, p_type, p_brand,
  CASE p_type WHEN 'ECONOMY' THEN '11110' WHEN 'STANDARD' THEN '12110' WHEN 'SMALL' THEN '14030'
    WHEN 'MEDIUM' THEN '31110' WHEN 'LARGE' THEN '99810' ELSE p_type END AS sector_code
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "a_sector": """
SELECT ord, aid, sector_code,
  CASE WHEN p_type = 'PROMO' THEN p_brand WHEN p_type <> 'LARGE' THEN left(sector_code, 3) END AS sector_group
FROM a_sector0""",
    "a_budget": f"""
SELECT {LINE_ORDER} AS ord, l_orderkey::varchar AS aid, l_extendedprice AS value,
  CASE l_returnflag WHEN 'R' THEN 'EUR' ELSE 'USD' END AS currency,
  CASE WHEN l_linenumber < 7 THEN l_extendedprice END AS usd,
  CASE WHEN l_linenumber < 7 THEN l_extendedprice END / 1.0823 AS eur
FROM lineitem""",
    "a_location": """
SELECT (l_linenumber::bigint << 40) + l_suppkey AS ord, l_orderkey::varchar AS aid,
  CASE WHEN s_nationkey > 0 THEN s_name END AS name,
  s_nationkey::varchar AS lat, (-s_nationkey)::varchar AS lon
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "b_activity": f"""
SELECT 'L' || o_orderkey::varchar AS link, CASE WHEN o_orderdate < timestamp '2001-01-01'
    THEN {IDENTIFIER.format('o_orderkey')} ELSE 'NEW-' || o_orderkey::varchar END AS identifier,
  'Order ' || o_orderkey::varchar AS title, c_mktsegment AS reporting,
  CASE o_orderstatus WHEN 'O' THEN 'Implementation' WHEN 'F' THEN 'Closed' END AS status_label,
  strftime(o_orderdate, '%Y-%m-%d') AS date_debut
FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL
SELECT 'S' || s_suppkey::varchar, 'EXT-' || s_suppkey::varchar, s_name, s_name, 'Implementation', '2000-01-01'
FROM supplier""",
    "b_recipient": f"""
SELECT 'L' || o_orderkey::varchar AS link, 'KM' AS code, {SHARE} AS percentage FROM orders
UNION ALL SELECT 'L' || o_orderkey::varchar, 'XX', '60' FROM orders WHERE o_orderpriority = '3-MEDIUM'
UNION ALL SELECT 'L' || o_orderkey::varchar, 'KM', {SHARE} FROM orders
  WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'
UNION ALL SELECT 'S' || s_suppkey::varchar, 'KM', NULL FROM supplier""",
    "b_trans": f"""
SELECT 'L' || l_orderkey::varchar AS link, {IDENTIFIER.format('l_orderkey')} AS identifier,
  CASE l_returnflag WHEN 'A' THEN '3' WHEN 'N' THEN '4' WHEN 'R' THEN '2' END AS type,
  CASE WHEN l_tax < 0.08 THEN strftime(l_shipdate, '%Y-%m-%d') END AS txdate,
  l_extendedprice * (1 - l_discount) AS usd
FROM lineitem
UNION ALL
SELECT 'S' || s_suppkey::varchar, 'EXT-' || s_suppkey::varchar, '3', '2000-01-01', s_acctbal FROM supplier""",
    "b_spend": "SELECT * FROM b_trans WHERE type IN ('3', '4')",
    "b_keys": """
SELECT link FROM b_recipient WHERE code = 'KM' GROUP BY link
HAVING count(*) = 1 AND max(coalesce(try_cast(percentage AS double), 100)) >= 99""",
    "a_keys": """
SELECT DISTINCT aid FROM a_country WHERE country_code = 'KM'
  AND (try_cast(country_percent AS double) = 100 OR country_percent IS NULL)""",
    "sole_keys": """
SELECT c.aid FROM a_country c WHERE c.country_code = 'KM'
  AND (SELECT count(*) FROM a_country c2 WHERE c2.aid = c.aid) = 1""",
    "a_spend": """
SELECT aid, coalesce(sum(trans_usd), 0) AS usd FROM a_trans WHERE trans_code IN ('D', 'E') GROUP BY aid""",
    "a_ids": "SELECT DISTINCT trim(aid) AS identifier FROM a_act WHERE aid IN (SELECT aid FROM a_keys)",
    "b_ids": "SELECT DISTINCT trim(identifier) AS identifier FROM b_activity WHERE link IN (SELECT link FROM b_keys)",
    "b_dataset": """
SELECT a.*, coalesce(s.usd, 0) AS montant_verse_usd_iati_tables, g.raw AS budget_raw_iati_tables
FROM (SELECT DISTINCT b.identifier AS aid, b.title, b.reporting, b.status_label, b.date_debut, NULL::varchar AS date_fin,
        coalesce(try_cast(r.percentage AS double), 100) AS country_percent,
        CASE WHEN coalesce(try_cast(r.percentage AS double), 100) = 100 THEN 'Non' ELSE 'Oui' END AS projet_multi_pays
      FROM b_activity b JOIN b_recipient r ON r.link = b.link WHERE r.code = 'KM') a
LEFT JOIN (SELECT identifier, coalesce(sum(usd), 0) AS usd FROM b_spend GROUP BY identifier) s ON s.identifier = a.aid
LEFT JOIN (SELECT identifier, sum(value) AS raw FROM (
        SELECT {id} AS identifier, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice ELSE 0 END AS value,
          'L' || o_orderkey::varchar AS link FROM orders) u
      WHERE link IN (SELECT link FROM b_recipient WHERE code = 'KM') GROUP BY identifier) g ON g.identifier = a.aid
""".replace("{id}", IDENTIFIER.format("o_orderkey")),
    "year_cmp": """
SELECT year, coalesce(it, 0) AS it_usd, coalesce(dp, 0) AS dp_usd FROM
  (SELECT left(txdate, 4) AS year, sum(usd) AS it FROM b_spend
   WHERE txdate IS NOT NULL AND link IN (SELECT link FROM b_keys) GROUP BY 1)
  FULL JOIN
  (SELECT (trans_day // 10000)::varchar AS year, coalesce(sum(trans_usd), 0) AS dp FROM a_trans
   WHERE trans_code IN ('D', 'E') AND trans_day IS NOT NULL AND aid IN (SELECT aid FROM a_keys) GROUP BY 1)
  USING (year)""",
    "year_gaps": """
SELECT year, it_usd, dp_usd, it_usd - dp_usd AS gap_usd, (it_usd - dp_usd) / nullif(dp_usd, 0) * 100 AS gap_pct
FROM year_cmp""",
    "spot": """
SELECT t.link AS _link_activity, nullif(trim(b.identifier), '') AS identifier, b.reporting AS reporter, it_usd,
  CASE WHEN nullif(trim(b.identifier), '') IS NOT NULL THEN coalesce(s.usd, 0) END AS dp_usd
FROM (SELECT link, sum(usd) AS it_usd FROM b_spend WHERE link IN (SELECT link FROM b_keys)
      GROUP BY link ORDER BY it_usd DESC, link LIMIT 10) t
LEFT JOIN b_activity b ON b.link = t.link
LEFT JOIN a_spend s ON s.aid = trim(b.identifier)""",
    "shared_all": """
SELECT t.identifier AS iatiidentifier, t.it_usd, coalesce(s.usd, 0) AS dp_usd,
  t.it_usd - coalesce(s.usd, 0) AS gap_usd,
  (t.it_usd - coalesce(s.usd, 0)) / nullif(coalesce(s.usd, 0), 0) * 100 AS gap_pct
FROM (SELECT trim(identifier) AS identifier, sum(usd) AS it_usd FROM b_spend WHERE link IN (SELECT link FROM b_keys)
      GROUP BY trim(identifier)) t
LEFT JOIN (SELECT trim(aid) AS identifier, sum(usd) AS usd FROM a_spend GROUP BY trim(aid)) s ON s.identifier = t.identifier
WHERE t.identifier IN (SELECT identifier FROM a_ids) AND t.identifier IN (SELECT identifier FROM b_ids)""",
    "tracked": """
SELECT a.*, coalesce(s.d, 0) AS d, coalesce(s.e, 0) AS e, coalesce(s.de, 0) AS de,
  trim(a.aid) IN (SELECT identifier FROM b_ids) AS known
FROM a_act a
LEFT JOIN (SELECT aid,
    sum(CASE WHEN trans_code = 'D' THEN coalesce(trans_usd, 0) ELSE 0 END) AS d,
    sum(CASE WHEN trans_code = 'E' THEN coalesce(trans_usd, 0) ELSE 0 END) AS e,
    sum(CASE WHEN trans_code IN ('D', 'E') THEN coalesce(trans_usd, 0) ELSE 0 END) AS de
  FROM a_trans GROUP BY aid) s ON s.aid = a.aid
WHERE a.aid IN (SELECT aid FROM a_keys)""",
    "figures": """
SELECT count(*) AS n_activities, count(*) FILTER (known) AS n_present, count(*) FILTER (NOT known) AS n_missing,
  coalesce(sum(de) FILTER (known), 0) AS present_usd, coalesce(sum(de) FILTER (NOT known), 0) AS missing_usd,
  sum(de) AS all_usd FROM tracked""",
    "reg_status": """
SELECT m.identifier,
  CASE WHEN o_orderpriority IS NULL OR o_orderpriority = '4-NOT SPECIFIED' THEN 'unanswered'
       WHEN o_orderpriority <> '2-HIGH' THEN 'found' ELSE 'not_found' END AS registry_status,
  trim(coalesce(a.reporting, '')) AS publisher
FROM (SELECT identifier FROM a_ids EXCEPT SELECT identifier FROM b_ids) m
JOIN a_act a ON a.aid = m.identifier
LEFT JOIN orders ON o_orderkey::varchar = m.identifier""",
    "t_obs": """
SELECT flux, CASE p_type WHEN 'ECONOMY' THEN '01-05_Animal' WHEN 'STANDARD' THEN '27-27_Fuels'
    WHEN 'SMALL' THEN '84-85_MachElec' ELSE p_type END AS section_code,
  CASE c_nationkey WHEN 0 THEN 'WLD' WHEN 1 THEN 'FRA' WHEN 2 THEN 'ARE' ELSE n_name END AS partner, annee,
  CASE WHEN c_nationkey = 5 THEN 0 WHEN c_nationkey <> 6 THEN usd / 1000 END AS thousands
FROM (SELECT CASE l_returnflag WHEN 'R' THEN 'M' ELSE 'X' END AS flux, p_type, c_nationkey, n_name,
    year(l_shipdate) AS annee, sum(l_extendedprice) AS usd
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL)""",
    "bulk": """
SELECT year(l_shipdate)::varchar AS period, l_suppkey::varchar AS "reporterCode", lpad(l_partkey::varchar, 6, '0') AS "cmdCode",
  CASE l_returnflag WHEN 'R' THEN 'M' ELSE 'X' END AS "flowCode", l_extendedprice::decimal(18, 2)::varchar AS "primaryValue"
FROM lineitem""",
    "hs": _values(fixed.HS_SECTIONS),
    "partners": _values(fixed.PARTNERS),
    "rates": f"SELECT code::int AS annee, label::double AS taux FROM ({_values(fixed.FALLBACK_RATES)})",
    "sectors": _values(fixed.SECTORS),
    "groups": _values(fixed.SECTOR_GROUPS),
    "flows": _values(fixed.FLOW_TYPES),
    "fins": _values(fixed.FINANCE_TYPES),
    "statuses": _values(fixed.ACTIVITY_STATUS),
    "regions": _values(fixed.DONOR_REGIONS),
    "prefixes": _values(fixed.BILATERAL_PREFIXES),
    "facts": """
SELECT o.annee, CASE flux WHEN 'X' THEN 'Export' ELSE 'Import' END AS flux, section_code,
  coalesce(hs.label, section_code) AS section_libelle, partner AS partenaire_code_iso3,
  coalesce(p.label, partner) AS partenaire_pays,
  round(thousands * 1000, 2) AS valeur_usd,
  round(round(thousands * 1000, 2) / taux, 2) AS valeur_eur,
  round(round(round(thousands * 1000, 2) / taux, 2) * 491.968, 0) AS valeur_kmf,
  taux AS taux_usd_eur, 'COM' AS reporter_code, 'Union des Comores' AS reporter_pays
FROM t_obs o LEFT JOIN hs ON hs.code = section_code LEFT JOIN partners p ON p.code = partner
LEFT JOIN rates r ON r.annee = o.annee
WHERE partner <> 'WLD' AND thousands IS NOT NULL AND thousands <> 0""",
    "funder": f"""
SELECT a.aid, a.reporting, a.reporting_ref,
  CASE WHEN {_mentions("coalesce(a.reporting, '')", fixed.words(fixed.MULTILATERAL_NAMES))} THEN 'Multilatéral'
    WHEN starts_with(a.reporting_ref, 'XM-DAC-') OR starts_with(a.reporting_ref, 'XM-IATI-') THEN 'Multilatéral'
    WHEN p.label IS NOT NULL THEN p.label
    WHEN {_mentions("coalesce(a.reporting, '')", fixed.words(fixed.NGO_KEYWORDS))} THEN 'ONG'
    ELSE 'Autre' END AS pays_bailleur
FROM a_act a LEFT JOIN prefixes p ON starts_with(upper(a.reporting_ref), p.code)""",
    "donors": """
SELECT f.*, CASE WHEN pays_bailleur IN ('Multilatéral', 'ONG', 'Autre') THEN pays_bailleur ELSE 'Bilatéral' END
  AS type_bailleur, coalesce(r.label, 'Autre') AS region_bailleur
FROM funder f LEFT JOIN regions r ON r.code = pays_bailleur""",
    "sec_rank": """
SELECT aid, sector_code AS v, coalesce(l.label, sector_code) AS l, sector_group AS g,
  coalesce(gl.label, sector_group) AS gl, ord
FROM a_sector s LEFT JOIN sectors l ON l.code = sector_code LEFT JOIN groups gl ON gl.code = sector_group""",
    "fl_rank": """
SELECT aid, flow, coalesce(f.label, flow) AS flux, fin, coalesce(n.label, fin) AS financement, ord
FROM a_trans LEFT JOIN flows f ON f.code = flow LEFT JOIN fins n ON n.code = fin""",
}


def _first_list(view: str, value: str, out: str) -> str:
    """``aid, out``: distinct values by first appearance, as comma-joined text."""
    return f"""(SELECT aid, coalesce(string_agg(v, ', ' ORDER BY o, v) FILTER (v IS NOT NULL), '') AS {out}
  FROM (SELECT aid, {value} AS v, min(ord) AS o FROM {view} GROUP BY aid, {value}) GROUP BY aid)"""


def _joined_lists(view: str, columns: dict[str, str]) -> str:
    parts = [_first_list(view, value, out) for value, out in columns.items()]
    return " JOIN ".join(f"{p} t{i}" + (" USING (aid)" if i else "") for i, p in enumerate(parts))


VIEWS["sec_lists"] = "SELECT * FROM " + _joined_lists("sec_rank", {
    "v": "sector_code", "g": "sector_group", "l": "secteur_detail", "gl": "secteur_principal"})
VIEWS["flow_lists"] = "SELECT * FROM " + _joined_lists("fl_rank", {
    "flow": "trans_flow_code", "flux": "flux", "fin": "trans_finance_code", "financement": "financement"})
VIEWS["loc_lists"] = "SELECT * FROM " + _joined_lists("a_location", {
    "name": "location_name", "lat": "location_latitude", "lon": "location_longitude"})
VIEWS["budgets"] = f"""
SELECT * FROM {_first_list("a_budget", "currency", "budget_currency")} JOIN
  (SELECT aid, sum(value) AS budget_value, coalesce(sum(usd), 0) AS budget_usd, coalesce(sum(eur), 0) AS budget_eur,
     coalesce(sum(eur * 491.96775), 0) AS budget_kmf FROM a_budget GROUP BY aid) USING (aid)"""
VIEWS["instruments"] = f"""
SELECT aid, CASE WHEN count(fin) = 0 THEN 'Inconnu'
  WHEN bool_or(fin IN ({_list(fixed.GRANT_CODES)})) AND bool_or(fin IN ({_list(fixed.LOAN_CODES)})) THEN 'Mixte'
  WHEN bool_or(fin IN ({_list(fixed.GRANT_CODES)})) THEN 'Don'
  WHEN bool_or(fin IN ({_list(fixed.LOAN_CODES)})) THEN 'Prêt' ELSE 'Autre' END AS instrument_financement
FROM a_trans GROUP BY aid"""
VIEWS["weighted"] = """
SELECT t.aid, s.share,
  sum(CASE WHEN trans_code = 'D' THEN coalesce(trans_usd, 0) ELSE 0 END) * share / 100 AS d,
  sum(CASE WHEN trans_code = 'E' THEN coalesce(trans_usd, 0) ELSE 0 END) * share / 100 AS e,
  sum(CASE WHEN trans_code = 'C' THEN coalesce(trans_usd, 0) ELSE 0 END) * share / 100 AS c,
  sum(CASE WHEN trans_code IN ('D', 'E') THEN coalesce(trans_usd, 0) ELSE 0 END) * share / 100 AS de,
  sum(CASE WHEN trans_code IN ('D', 'E') THEN coalesce(trans_eur, 0) ELSE 0 END) * share / 100 AS de_eur,
  count(*) AS n
FROM a_trans t JOIN a_share s ON s.aid = t.aid GROUP BY t.aid, s.share"""
VIEWS["summary"] = """
SELECT region_bailleur, pays_bailleur, type_bailleur,
  sum(coalesce(trans_usd, 0) * share / 100) AS total_usd, sum(coalesce(trans_eur, 0) * share / 100) AS total_eur,
  sum(coalesce(trans_eur, 0) * share / 100 * 491.96775) AS total_kmf
FROM a_trans t JOIN a_share s ON s.aid = t.aid JOIN donors d ON d.aid = t.aid
WHERE trans_code IN ('D', 'E') AND trans_day IS NOT NULL GROUP BY ALL"""
VIEWS["funders"] = """
SELECT a.reporting AS name, count(*) AS n, coalesce(sum(de), 0) AS usd, coalesce(sum(de_eur), 0) AS eur,
  coalesce(sum(de_eur * 491.96775), 0) AS kmf
FROM a_act a JOIN a_share s ON s.aid = a.aid LEFT JOIN weighted w ON w.aid = a.aid GROUP BY a.reporting"""


def _needed(sql: str) -> list[str]:
    """Views that a text uses, each after those it uses itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+\(?{name}\b", text):
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def _statement(body: str) -> str:
    views = _needed(body)
    head = "WITH " + ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in views) + "\n" if views else ""
    return head + body.strip()


def _round(*names: str, digits: int | None = None) -> str:
    return ", ".join(f"round({n}, {_digits(n) if digits is None else digits}) AS {n}" for n in names)


def _totals(*names: str) -> str:
    return ", ".join(f"round({n}, {({'usd': 3, 'eur': 1, 'kmf': 0})[n[-3:]]}) AS {n}" for n in names)


def _digits(name: str) -> int:
    return {"kmf": 0, "eur": 2}.get(name[-3:], 4)


BODIES = {
    "donor_top4_autres": f"""
SELECT position, is_others, bailleur_de_fonds, nb_projets,
  {_totals('montant_verse_usd', 'montant_verse_eur', 'montant_verse_kmf')}, left(bailleur_de_fonds, 46) AS libelle
FROM (
  SELECT r AS position, false AS is_others, name AS bailleur_de_fonds, n AS nb_projets,
    usd AS montant_verse_usd, eur AS montant_verse_eur, kmf AS montant_verse_kmf
  FROM (SELECT *, row_number() OVER (ORDER BY usd DESC, name NULLS LAST) AS r FROM funders) WHERE r <= 4
  UNION ALL
  SELECT 5, true, 'Autres', sum(n)::bigint, sum(usd), sum(eur), sum(kmf)
  FROM (SELECT *, row_number() OVER (ORDER BY usd DESC, name NULLS LAST) AS r FROM funders) WHERE r > 4)""",
    "donor_report_totals": """
SELECT sum(n)::bigint AS nb_projets, sum(n)::bigint AS n_projets, count(name) AS n_bailleurs,
  round(sum(usd), 3) AS total_usd, round(sum(eur), 1) AS total_eur, round(sum(kmf), 0) AS total_kmf FROM funders""",
    "activity_star": f"""
SELECT a.aid AS id_projet, coalesce(fr.title, a.title) AS titre, coalesce(fr.description, a.description) AS description,
  'https://d-portal.org/ctrack.html?slug=' || slug || '#view=act' AS lien_source,
  a.status_code || '_' || st.label AS statut,
  strftime(date '1970-01-01' + day_start::int, '%Y-%m-%d') AS date_debut,
  strftime(date '1970-01-01' + day_end::int, '%Y-%m-%d') AS date_fin,
  a.reporting AS bailleur_de_fonds, type_bailleur, pays_bailleur, region_bailleur, instrument_financement,
  round(de, 4) AS montant_verse_usd, round(de_eur, 2) AS montant_verse_eur,
  round(de_eur * 491.96775, 0) AS montant_verse_kmf,
  round(budget_usd, 4) AS budget_prevu_usd, round(budget_eur, 2) AS budget_prevu_eur,
  round(budget_kmf, 0) AS budget_prevu_kmf, secteur_principal, secteur_detail,
  location_name AS localisation, location_latitude AS latitudes, location_longitude AS longitudes,
  CASE WHEN s.share = 100 THEN 'Non' ELSE 'Oui' END AS projet_multi_pays
FROM a_act a JOIN a_share s ON s.aid = a.aid LEFT JOIN a_fr fr ON fr.aid = a.aid
LEFT JOIN statuses st ON st.code = a.status_code JOIN donors d ON d.aid = a.aid
LEFT JOIN sec_lists sl ON sl.aid = a.aid LEFT JOIN budgets b ON b.aid = a.aid
LEFT JOIN weighted w ON w.aid = a.aid LEFT JOIN instruments i ON i.aid = a.aid
LEFT JOIN loc_lists ll ON ll.aid = a.aid""",
    "donor_summary": f"""
SELECT region_bailleur, pays_bailleur, type_bailleur, {_totals('total_usd', 'total_eur', 'total_kmf')},
  '$' || printf('%,d', round_even(total_usd, 0)::bigint) AS text_usd,
  '€' || printf('%,d', round_even(total_eur, 0)::bigint) AS text_eur,
  printf('%,d', round_even(total_kmf, 0)::bigint) || ' KMF' AS text_kmf
FROM summary""",
    "donor_grand_total": """
SELECT round(sum(total_usd), 3) AS total_usd, round(sum(total_eur), 1) AS total_eur,
  round(sum(total_kmf), 0) AS total_kmf FROM summary""",
    "activity_country_inner": """
SELECT a.aid, title, reporting_ref, country_code, country_percent
FROM a_act a JOIN a_country c ON c.aid = a.aid WHERE country_code = 'KM'""",
    "sector_three_way": """
SELECT count(DISTINCT a.aid) AS n_activities FROM a_act a JOIN a_country c ON c.aid = a.aid
JOIN a_sector s ON s.aid = a.aid
WHERE c.country_code = 'KM' AND (SELECT count(*) FROM a_country c2 WHERE c2.aid = a.aid) = 1
  AND s.sector_code = '12110'""",
    "title_coalesce_left": """
SELECT a.aid, coalesce(f.title, a.title) AS title, coalesce(f.description, a.description) AS description
FROM a_act a LEFT JOIN a_fr f ON f.aid = a.aid""",
    "share_positive_flag": """
SELECT aid, country_code, share, CASE WHEN share = 100 THEN 'Non' ELSE 'Oui' END AS multi_country FROM (
  SELECT *, coalesce(try_cast(country_percent AS double), 100) AS share FROM a_country) WHERE share > 0""",
    "share_null_or_full": """
SELECT aid, country_code, country_percent FROM a_country
WHERE try_cast(country_percent AS double) = 100 OR country_percent IS NULL""",
    "status_label": """
SELECT aid, try_cast(status_code AS double) AS status_code, s.label AS status_label,
  CASE WHEN s.label IS NOT NULL THEN status_code || '_' || s.label END AS status
FROM a_act LEFT JOIN statuses s ON s.code = status_code""",
    "funder_class": "SELECT aid, reporting, reporting_ref, pays_bailleur, type_bailleur, region_bailleur FROM donors",
    "funder_class_counts": "SELECT type_bailleur, count(*) AS n FROM donors GROUP BY type_bailleur",
    "instrument_class": "SELECT aid, instrument_financement FROM instruments",
    "ordered_distinct_codes": """
SELECT aid, sector_code, sector_group, secteur_detail, secteur_principal FROM sec_lists""",
    "flow_and_finance_lists": """
SELECT aid, trans_flow_code, flux, trans_finance_code, financement FROM flow_lists""",
    "places": """
SELECT aid, row_number() OVER (PARTITION BY aid ORDER BY first, location_name NULLS FIRST, location_latitude NULLS FIRST,
    location_longitude NULLS FIRST) AS position, location_name, location_latitude, location_longitude
FROM (SELECT aid, name AS location_name, lat AS location_latitude, lon AS location_longitude, min(ord) AS first
      FROM a_location GROUP BY ALL)""",
    "location_lists": "SELECT aid, location_name, location_latitude, location_longitude FROM loc_lists",
    "budget_agg": f"""
SELECT aid, budget_currency, {_round('budget_value', 'budget_usd', 'budget_eur', 'budget_kmf')} FROM budgets""",
    "trans_weighted_conditional": """
SELECT aid, share, round(d, 4) AS disbursements_usd, round(e, 4) AS expenditures_usd, round(c, 4) AS commitments_usd,
  round(de, 4) AS total_de_usd, n AS n_transactions FROM weighted""",
    "dedup_first": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem) WHERE r = 1""",
    "date_text_url": """
SELECT o_orderkey::varchar AS aid, strftime(o_orderdate, '%Y-%m-%d') AS date_debut,
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + interval 100 day, '%Y-%m-%d') END AS date_fin,
  CASE WHEN o_orderpriority <> '5-LOW'
    THEN 'https://d-portal.org/ctrack.html?slug=ORD-' || o_orderkey::varchar || '#view=act' END AS url
FROM orders""",
    "code_label_zip": """
SELECT aid, string_agg(v || '_' || l, ', ' ORDER BY o, v) AS sectors,
  regexp_matches(arg_min(v, (o, v)), '^[0-9]') AS numeric_code
FROM (SELECT aid, v, l, min(ord) AS o FROM sec_rank GROUP BY aid, v, l) GROUP BY aid""",
    "single_country_subquery": """
SELECT status_code, count(DISTINCT aid) AS n_activities FROM a_act SEMI JOIN sole_keys USING (aid) GROUP BY status_code""",
    "commitment_total": """
SELECT round(sum(coalesce(trans_usd, 0)), 3) AS commitment_usd, count(DISTINCT a.aid) AS n_activities
FROM a_act a JOIN a_trans t ON t.aid = a.aid
WHERE trans_code = 'C' AND a.aid IN (SELECT aid FROM sole_keys)""",
    "single_country_keys": "SELECT link AS _link_activity FROM b_keys",
    "full_share_keys": """
SELECT DISTINCT aid FROM a_country
WHERE country_code = 'KM' AND coalesce(try_cast(country_percent AS double), 100) = 100""",
    "second_source_dataset": f"""
SELECT aid, title, reporting, status_label, date_debut, date_fin,
  {_round('montant_verse_usd_iati_tables', 'budget_raw_iati_tables')}, projet_multi_pays, country_percent
FROM b_dataset""",
    "spend_by_status": """
SELECT status_label, count(*) AS nb_activites, round(sum(montant_verse_usd_iati_tables), 1) AS total_usd
FROM b_dataset WHERE status_label IS NOT NULL GROUP BY status_label""",
    "multi_split": "SELECT projet_multi_pays, count(*) AS n_activities FROM b_dataset GROUP BY projet_multi_pays",
    "second_source_total": """
SELECT count(*) AS n_activities, round(sum(usd), 1) AS total_usd
FROM (SELECT aid, max(montant_verse_usd_iati_tables) AS usd FROM b_dataset GROUP BY aid)""",
    "total_gap_verdict": """
SELECT round(it, 1) AS it_usd, round(dp, 3) AS dp_usd, n AS dp_activities, round(it - dp, 1) AS gap_usd,
  round((it - dp) / dp * 100, 4) AS gap_pct,
  CASE WHEN abs((it - dp) / dp * 100) < 2 THEN 'excellent' WHEN abs((it - dp) / dp * 100) < 5 THEN 'good'
    WHEN abs((it - dp) / dp * 100) < 10 THEN 'moderate' ELSE 'significant' END AS verdict
FROM (SELECT (SELECT sum(usd) FROM b_spend WHERE link IN (SELECT link FROM b_keys)) AS it,
  (SELECT sum(usd) FROM a_spend WHERE aid IN (SELECT aid FROM a_keys)) AS dp,
  (SELECT count(*) FROM a_spend WHERE aid IN (SELECT aid FROM a_keys)) AS n)""",
    "total_check_verdict": """
SELECT n AS n_activities, round(it, 1) AS it_usd, round(it - 1726470646, 1) AS gap_usd,
  round((it - 1726470646) / 1726470646 * 100, 4) AS gap_pct,
  CASE WHEN abs((it - 1726470646) / 1726470646 * 100) < 5 THEN 'equivalent'
    WHEN abs((it - 1726470646) / 1726470646 * 100) < 10 THEN 'freshness' ELSE 'investigate' END AS verdict
FROM (SELECT sum(usd) AS it, count(DISTINCT identifier) AS n FROM b_spend WHERE link IN (SELECT link FROM b_keys))""",
    "year_gap": f"""
SELECT year, {_round('it_usd', 'gap_usd', digits=1)}, {_totals('dp_usd')}, {_round('gap_pct')},
  coalesce(abs(gap_pct) > 10, false) AND dp_usd > 100000 AS flagged FROM year_gaps""",
    "gap_dispersion": """
SELECT count(gap_pct) AS n_gaps, round(stddev_samp(gap_pct), 4) AS spread, round(median(gap_pct), 4) AS median_gap,
  CASE WHEN count(gap_pct) = 0 THEN NULL WHEN stddev_samp(gap_pct) < 5 THEN 'uniform' ELSE 'variable' END AS verdict
FROM year_gaps WHERE dp_usd > 100000""",
    "top10_spot": """
SELECT _link_activity, identifier, reporter, round(it_usd, 4) AS it_usd, round(dp_usd, 4) AS dp_usd,
  round((it_usd - dp_usd) / nullif(dp_usd, 0) * 100, 4) AS gap_pct,
  CASE WHEN identifier IS NULL THEN 'N/A' WHEN dp_usd = 0 THEN '+100.0%'
    ELSE printf('%+.1f', (it_usd - dp_usd) / dp_usd * 100) || '%' END AS gap_text
FROM spot""",
    "top10_spot_counts": """
SELECT count(*) FILTER (dp_usd > 0) AS matched, count(*) FILTER (dp_usd = 0 AND identifier IS NOT NULL) AS missing,
  CASE WHEN count(*) FILTER (dp_usd = 0 AND identifier IS NOT NULL) = 0 THEN 'all_present' ELSE 'some_missing' END
  AS verdict FROM spot""",
    "id_sets": """
SELECT coalesce(a.identifier, b.identifier) AS identifier, a.identifier IS NOT NULL AS in_first,
  b.identifier IS NOT NULL AS in_second FROM a_ids a FULL JOIN b_ids b ON a.identifier = b.identifier""",
    "id_verdict": """
SELECT *, CASE WHEN only_first = 0 AND only_second = 0 THEN 'identical' WHEN only_first = 0 THEN 'second_has_more'
  WHEN only_second = 0 THEN 'first_has_more' ELSE 'both_diverge' END AS verdict
FROM (SELECT (SELECT count(*) FROM (SELECT identifier FROM a_ids INTERSECT SELECT identifier FROM b_ids)) AS in_both,
  (SELECT count(*) FROM (SELECT identifier FROM a_ids EXCEPT SELECT identifier FROM b_ids)) AS only_first,
  (SELECT count(*) FROM (SELECT identifier FROM b_ids EXCEPT SELECT identifier FROM a_ids)) AS only_second)""",
    "id_set_operations": """
SELECT identifier, 'only_first' AS part FROM (SELECT identifier FROM a_ids EXCEPT SELECT identifier FROM b_ids)
UNION ALL SELECT identifier, 'only_second' FROM (SELECT identifier FROM b_ids EXCEPT SELECT identifier FROM a_ids)
UNION ALL SELECT identifier, 'in_both' FROM (SELECT identifier FROM a_ids INTERSECT SELECT identifier FROM b_ids)""",
    "exclusive_value": """
SELECT s.aid, round(s.usd, 4) AS total_usd FROM a_spend s
WHERE s.aid IN (SELECT a.aid FROM a_act a WHERE a.aid IN (SELECT aid FROM a_keys)
  AND trim(a.aid) NOT IN (SELECT identifier FROM b_ids))""",
    "exclusive_total": """
SELECT count(*) AS n_activities, round(sum(s.usd), 3) AS total_usd FROM a_spend s
WHERE s.aid IN (SELECT a.aid FROM a_act a WHERE a.aid IN (SELECT aid FROM a_keys)
  AND trim(a.aid) NOT IN (SELECT identifier FROM b_ids))""",
    "exclusive_second": """
SELECT identifier, reporting AS reporter FROM b_activity WHERE link IN (SELECT link FROM b_keys)
  AND trim(identifier) NOT IN (SELECT identifier FROM a_ids)""",
    "shared_top20_gap": f"""
SELECT iatiidentifier, {_round('it_usd', 'dp_usd', 'gap_usd', 'gap_pct')},
  coalesce(abs(gap_pct) > 20, false) AS flagged FROM shared_all ORDER BY shared_all.it_usd DESC, iatiidentifier LIMIT 20""",
    "shared_dispersion": """
SELECT count(gap_pct) AS n_gaps, round(stddev_samp(gap_pct), 4) AS spread, round(median(gap_pct), 4) AS median_gap,
  CASE WHEN stddev_samp(gap_pct) < 5 THEN 'uniform' ELSE 'variable' END AS verdict FROM shared_all""",
    "missing_detail": """
SELECT aid AS iati_identifier, reporting AS reporting_org, reporting_ref AS reporting_org_ref, title AS activity_title,
  status_code, day_start::varchar AS start_date, day_end::varchar AS end_date,
  round(d, 4) AS disbursements_usd, round(e, 4) AS expenditures_usd, round(de, 4) AS total_de_usd
FROM tracked WHERE NOT known""",
    "missing_by_publisher": """
SELECT reporting AS publisher, count(*) AS n_activities, round(sum(de), 4) AS total_de_usd
FROM tracked WHERE NOT known AND reporting IS NOT NULL GROUP BY reporting""",
    "missing_figures": f"""
SELECT n_activities, n_present, n_missing, {_totals('present_usd', 'missing_usd', 'all_usd')},
  round(missing_usd / all_usd * 100, 2) AS gap_pct FROM figures""",
    "missing_summary": """
SELECT 2 AS position, 'activities' AS metric, n_activities::varchar AS value FROM figures
UNION ALL SELECT 3, 'present', n_present::varchar FROM figures
UNION ALL SELECT 4, 'missing', n_missing::varchar FROM figures
UNION ALL SELECT 5, 'present_usd', present_usd::decimal(38, 2)::varchar FROM figures
UNION ALL SELECT 6, 'missing_usd', missing_usd::decimal(38, 2)::varchar FROM figures
UNION ALL SELECT 7, 'coverage_gap_pct', round(missing_usd / all_usd * 100, 2)::varchar FROM figures""",
    "registry_status": """
SELECT identifier, registry_status, CASE WHEN registry_status = 'found' THEN 1 END AS occurrences, publisher
FROM reg_status""",
    "registry_counts": "SELECT registry_status, count(*) AS n FROM reg_status GROUP BY registry_status",
    "trade_facts": "SELECT * FROM facts",
    "trade_stats": """
SELECT count(*) AS n_total, count(*) FILTER (flux = 'Export') AS n_export, count(*) FILTER (flux = 'Import') AS n_import,
  count(DISTINCT section_code) AS n_sections, count(DISTINCT partenaire_code_iso3) AS n_partners,
  min(annee) AS first_year, max(annee) AS last_year FROM facts""",
    "latest_releases": """
SELECT user_id AS "reporterCode", strftime(ts, '%Y%m%d') AS period, 'file-' || min(event_id)::varchar AS "fileUrl"
FROM events WHERE event_type <> 'error' AND NOT EXISTS (
  SELECT 1 FROM events e2 WHERE e2.event_type = 'purchase' AND e2.user_id = events.user_id
    AND strftime(e2.ts, '%Y%m%d') = strftime(events.ts, '%Y%m%d'))
GROUP BY 1, 2""",
    "period_availability": """
SELECT r.user_id AS "reporterCode", p.period, count(e.user_id) AS n_records, count(e.user_id) > 0 AS has_data
FROM (SELECT DISTINCT user_id FROM events) r
JOIN (SELECT strftime(date '2024-01-01' + i::int, '%Y%m%d') AS period FROM range(33) t(i)) p ON true
LEFT JOIN events e ON e.user_id = r.user_id AND strftime(e.ts, '%Y%m%d') = p.period
GROUP BY 1, 2""",
    "code_search": """
SELECT p_partkey::varchar AS id, p_name AS text FROM part
WHERE starts_with(p_partkey::varchar, '1') AND contains(lower(p_name), 'ring')""",
    "union_batches": """
SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier""",
    "page_offset": """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 50""",
    "page_by_range": """
SELECT * FROM (SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position, o_orderkey, o_totalprice FROM orders)
WHERE position BETWEEN 51 AND 100""",
    "page_firsts": """
SELECT *, (position - 1) // 50 AS page FROM (
  SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position, o_orderkey, o_totalprice FROM orders)
WHERE (position - 1) % 50 = 0""",
    "object_envelope_rows": """
SELECT aid, country_code, country_percent FROM a_country
WHERE aid NOT IN (SELECT o_orderkey::varchar FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')""",
    "array_envelope_rows": """
SELECT 'L' || o_orderkey::varchar AS _link_activity, NULL::varchar AS value, o_orderpriority AS value_currency,
  o_orderkey::varchar AS iatiidentifier FROM orders WHERE o_orderpriority <> '1-URGENT'""",
    "xml_series_flatten": """
SELECT flux, section_code, 'A' AS "FREQ", partner AS "PARTNER", annee::varchar AS "TIME_PERIOD",
  thousands::decimal(24, 5)::varchar AS "OBS_VALUE" FROM t_obs""",
    "translated_rows": """
SELECT a.aid, coalesce(f.title, a.title) AS title, coalesce(f.description, a.description) AS description
FROM a_act a LEFT JOIN a_fr f ON f.aid = a.aid""",
    "live_rates": "SELECT year(o_orderdate) AS annee, min(o_totalprice) AS taux FROM orders GROUP BY 1",
    "release_rows": """
SELECT user_id AS "reporterCode", strftime(ts, '%Y%m%d') AS period,
  CASE WHEN event_type <> 'error' THEN 'file-' || event_id::varchar END AS "fileUrl" FROM events""",
    "releases_of_reporter": """
SELECT user_id AS "reporterCode", strftime(ts, '%Y%m%d') AS period,
  CASE WHEN event_type <> 'error' THEN 'file-' || event_id::varchar END AS "fileUrl" FROM events WHERE user_id = 7""",
    "code_list_rows": "SELECT p_partkey::varchar AS id, p_name AS text FROM part",
    "availability_rows": """
SELECT strftime(ts, '%Y%m%d') AS period, upper(event_type) AS "reporterISO", event_type AS "reporterDesc",
  count(*) AS "totalRecords", max(strftime(ts, '%Y-%m-%d')) AS "lastReleased" FROM events GROUP BY 1, 2, 3""",
    "bulk_rows": "SELECT * FROM bulk",
    "selected_records": """
SELECT * FROM bulk WHERE period IN ('1996', '1997') AND "reporterCode" IN ('1', '2', '3', '4', '5') AND "flowCode" = 'M'
UNION ALL SELECT * FROM bulk WHERE "cmdCode" = '000007' AND "flowCode" = 'X'""",
    "section_lines": """
SELECT coalesce(l.flux, k.flux) AS flux, coalesce(l.section_code, k.section_code) AS section_code,
  coalesce(n_series, 0) AS n_series, coalesce(n_obs, 0) AS n_obs, coalesce(n_unreadable, 0) AS n_unreadable
FROM (SELECT flux, section_code, count(DISTINCT partner) FILTER (NOT lost) AS n_series,
        coalesce(count(*) FILTER (NOT lost), 0) AS n_obs, count(DISTINCT partner) FILTER (lost) AS n_unreadable
      FROM (SELECT *, flux = 'M' AND section_code = '27-27_Fuels' AS lost FROM t_obs) GROUP BY 1, 2) l
FULL JOIN (SELECT flux, code AS section_code FROM hs, (VALUES ('X'), ('M')) f(flux)) k
  ON k.flux = l.flux AND k.section_code = l.section_code""",
    "both_flows": "SELECT * FROM facts",
    "rate_json": """
SELECT o_custkey, year(o_orderdate) AS annee, min(o_totalprice) AS taux FROM orders
GROUP BY 1, 2 HAVING NOT bool_and(o_orderpriority = '1-URGENT')""",
}

BODIES["landed_star"] = BODIES["activity_star"]

#: The place of each row in published order, over the rows of another twin.
ORDERS = {
    "donor_summary": "total_usd DESC NULLS LAST, region_bailleur NULLS FIRST, pays_bailleur NULLS FIRST, type_bailleur NULLS FIRST",
    "trade_facts": "flux NULLS LAST, annee NULLS LAST, section_code NULLS LAST, partenaire_code_iso3 NULLS LAST",
    "year_gap": "year NULLS FIRST",
    "exclusive_value": "total_usd DESC NULLS LAST, aid",
    "missing_detail": "total_de_usd DESC NULLS LAST, iati_identifier NULLS FIRST",
    "registry_status": "identifier",
    "latest_releases": "\"reporterCode\", coalesce(period, '') DESC",
}
BODIES |= {
    f"{name}_ordered": f"SELECT row_number() OVER (ORDER BY {order}) AS position, * FROM ({BODIES[name]}) lines"
    for name, order in ORDERS.items()
}

ORACLES = {name: _statement(body) for name, body in BODIES.items()}
