"""The same results in plain SQL, for DuckDB on the same tables.

Written by hand against the data model; of the library it uses only the fixture texts
and the record layout.
"""

from __future__ import annotations

import re

from ledgerlink.operators.assemble import MAIN_COLUMNS, OUTPUT
from ledgerlink.plans.fixtures import VIEWS
from ledgerlink.sources.intake import ALIASES, FLAG_GUARDS
from ledgerlink.sources.layout import LAYOUT, RECORD_WIDTH

ODATE = "DATE '2024-06-30'"
RUN_TS, STORED = "'2024-06-30 00:00:00'", "strftime({}, '%Y-%m-%d %H:%M:%S')"
NEW_TIMES = f"{RUN_TS} AS insrt_ts, {RUN_TS} AS lu_ts"
FX_COLUMNS = set(re.findall(r"AS (\w+)(?:,|\n)", VIEWS["sub"]))
BAD_ID = (
    "(length(trim(empr_ein)) <> 9 OR NOT regexp_matches(empr_ein, '^[0-9]{9}$') OR vald_ein_cd = 'I')"
)
QUALITY = (
    "CASE substr(fnl_empr_err_tab, 1, 1) WHEN 'G' THEN 'GA' WHEN 'C' THEN 'CH' ELSE 'BA' END"
)
PLACE = ["addr1", "city", "state", "zip5"]


def _line() -> str:
    parts, at = [], 1
    for f in LAYOUT:
        if f.name == "state_key_code":  # lies inside state_key_code_full
            continue
        if f.start > at:
            parts.append(f"repeat(' ', {f.start - at})")
        value = f.name if f.name in FX_COLUMNS else "''"
        parts.append(f"rpad({value}, {f.width}, ' ')")
        at = f.start + f.width
    parts.append(f"repeat(' ', {RECORD_WIDTH + 1 - at})")
    return " || ".join(parts)


def _guards(table: str = "") -> str:
    return ", ".join(f"CASE WHEN {g} = 'Y' THEN {f} END AS {f}" for g, f, _ in FLAG_GUARDS)


_DERIVED = ", ".join(f"CASE WHEN {g} = 'Y' THEN {f} END AS {d}" for g, f, d in FLAG_GUARDS)
_ALIASES = ", ".join(f"{c} AS {a}" for a, c in ALIASES.items())
_ZERO = "'000000000'"
_SPECIAL_COLS = "qw_employer_name, addr1, addr2, addr3, city, state, zip5, zip4"

_ADDR_OUT = """{p}addr1 AS empr_addrln40_1, {p}addr2 AS empr_addrln40_2, {p}addr3 AS empr_addrln40_3,
 {p}city AS empr_city25, {p}state AS empr_st, {p}zip5 AS empr_zip5, {p}zip4 AS empr_zip4,
 {p}empr_forgn_cc AS empr_frgn_cntry_cd, {p}empr_forgn_c_name AS empr_frgn_cntry_nm,
 {p}empr_forgn_zip AS empr_frgnpzn, """ + QUALITY + """ AS addrck_pmycd,
 '' AS addrck_scycd_1, '' AS addrck_scycd_2, """ + ODATE + " AS app_odate"


def _special(reuse: bool) -> str:
    """Numbered special-id entities, with or without a look at the master."""
    sfx = "_reuse" if reuse else ""
    known = (
        """SELECT i.*, (SELECT min(empr_snum) FROM fx_special m WHERE m.empr_idfr = i.empr_idfr
   AND upper(trim(m.empr_nm)) = upper(trim(i.qw_employer_name))
   AND upper(trim(m.empr_addrln40_1)) = upper(trim(i.addr1)) AND upper(trim(m.empr_addrln40_2)) = upper(trim(i.addr2))
   AND upper(trim(m.empr_addrln40_3)) = upper(trim(i.addr3)) AND upper(trim(m.empr_city25)) = upper(trim(i.city))
   AND upper(trim(m.empr_st)) = upper(trim(i.state)) AND upper(trim(m.empr_zip5)) = upper(trim(i.zip5))
   AND upper(trim(m.empr_zip4)) = upper(trim(i.zip4))) AS known FROM special_in i"""
        if reuse
        else "SELECT *, CAST(NULL AS INT) AS known FROM special_in"
    )
    return f"""SELECT empr_idfr, {_SPECIAL_COLS}, first_id, CAST(CASE WHEN known IS NOT NULL THEN known
  ELSE coalesce((SELECT max(empr_snum) FROM fx_special m WHERE m.empr_idfr = s{sfx}.empr_idfr), 0)
   + row_number() OVER (PARTITION BY empr_idfr, known IS NULL ORDER BY first_id) END AS INT) AS empr_snum
 FROM ({known}) s{sfx}"""


def _changes(src: str, master: str, key: str, updates: bool = True, guard: str = "TRUE") -> str:
    """First source row per key, tagged I or U against the master."""
    keys = [k.strip() for k in key.split(",")]
    on = " AND ".join(f"s.{k} = m.{k}" for k in keys)
    stale = f"WHEN m.{keys[0]} IS NOT NULL AND m.app_odate <> {ODATE} AND {guard} THEN 'U'" if updates else ""
    return f"""SELECT * EXCLUDE (rn, input_order) FROM (
 SELECT CASE WHEN m.{keys[0]} IS NULL THEN 'I' {stale} END AS db_oper_typ,
  CAST(0 AS BIGINT) AS db_sort_num, CAST(0 AS BIGINT) AS db_uid, s.*
 FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY input_order) AS rn FROM ({src}) x) s
 LEFT JOIN {master} m ON {on} WHERE s.rn = 1) t WHERE db_oper_typ IS NOT NULL"""


_LINK_KEY = "empr_id, nm_snum, addr_snum"


def _links(extra: str, tail: str = "") -> str:
    return f"""SELECT input_order, work_ein AS empr_id, empr_addr_pntr AS addr_snum, empr_name_pntr AS nm_snum{extra},
 {ODATE} AS app_odate, CAST(NULL AS DATE) AS endt{tail} FROM main
 WHERE empr_table_ind <> 'O' AND empr_name_pntr > 0 AND empr_addr_pntr > 0"""


_GUARD = " AND ".join(
    f"upper(trim(s.{c})) = upper(trim(m.{c}))"
    for c in "empr_nm empr_addrln40_1 empr_addrln40_2 empr_addrln40_3 empr_city25 empr_st empr_zip5 empr_zip4".split()
)

CTES = {
    **VIEWS,
    "line": f"SELECT *, {_line()} AS value FROM sub",
    "feed": """SELECT input_order, CASE WHEN input_order % 1000 = 7 THEN '' WHEN input_order % 1000 = 8 THEN 'E'
 ELSE value END AS value FROM line""",
    "rec": f"""SELECT *, CASE
   WHEN (empr_addr_inp_ind_cd = 'X' AND trim(qw_employer_name) = '') OR batch_number = '999999' OR is_batch_999999 = 'Y' THEN 'unknown'
   WHEN substr(trim(empr_ein), 1, 1) = 'A' OR substr(lpad(trim(empr_ein), 9, '0'), 3, 7) = '0000000' THEN 'pseudo'
   ELSE 'regular' END AS cls
 FROM (SELECT * REPLACE (CASE WHEN ssn_val_code = 'I' THEN {_ZERO} ELSE wrk_ssn END AS wrk_ssn,
   CASE WHEN ssn_val_code = 'I' THEN {_ZERO} ELSE final_ssn END AS final_ssn,
   CASE WHEN {BAD_ID} THEN 'I' ELSE vald_ein_cd END AS vald_ein_cd,
   CASE WHEN {BAD_ID} THEN '' ELSE final_empr_nm END AS final_empr_nm,
   CASE WHEN {BAD_ID} THEN '' ELSE wrk_empr_nm END AS wrk_empr_nm, {_guards()}),
  {_DERIVED}, {_ALIASES} FROM sub) v""",
    "reg": """SELECT *, work_ein AS empr_id, upper(trim(qw_employer_name)) AS nm,
 upper(trim(addr1)) AS a1, upper(trim(city)) AS a2, upper(trim(state)) AS a3, upper(trim(zip5)) AS a4,
 upper(trim(opt_addr1)) AS o1, upper(trim(opt_city)) AS o2, upper(trim(opt_state)) AS o3, upper(trim(opt_zip5)) AS o4
 FROM rec WHERE cls = 'regular'""",
    # names
    "name_in": "SELECT empr_id, nm, min(input_order) AS first_id FROM reg WHERE nm <> '' GROUP BY empr_id, nm",
    "name_master": "SELECT empr_id, upper(trim(empr_nm)) AS nm, min(nm_snum) AS nm_snum FROM fx_name GROUP BY 1, 2",
    "exact": """SELECT i.empr_id, i.nm, m.nm_snum, CASE WHEN m.nm_snum IS NULL THEN 'N' ELSE 'F' END AS name_ind
 FROM name_in i LEFT JOIN name_master m ON i.empr_id = m.empr_id AND i.nm = m.nm""",
    "scored": """SELECT * FROM (SELECT i.empr_id, i.nm, m.nm AS master_nm, m.nm_snum, jaro_winkler_similarity(i.nm, m.nm) AS score
  FROM exact i JOIN name_master m ON i.empr_id = m.empr_id
  WHERE i.name_ind = 'N' AND length(i.nm) >= 4 AND length(m.nm) >= 4
   AND least(length(i.nm), length(m.nm)) >= CAST(0.72 AS DOUBLE) * greatest(length(i.nm), length(m.nm))) p
 WHERE score >= CAST(0.781 AS DOUBLE)""",
    "fuzzy_best": """SELECT empr_id, nm, nm_snum FROM (SELECT *, row_number() OVER (PARTITION BY empr_id, nm ORDER BY score DESC, nm_snum) AS rn
 FROM scored) x WHERE rn = 1""",
    "name_found": """SELECT e.empr_id, e.nm, coalesce(e.nm_snum, f.nm_snum) AS nm_snum
 FROM exact e LEFT JOIN fuzzy_best f ON e.empr_id = f.empr_id AND e.nm = f.nm""",
    "name_new": """SELECT empr_id, nm, CAST(coalesce((SELECT max(nm_snum) FROM fx_name x WHERE x.empr_id = f.empr_id), 0)
  + row_number() OVER (PARTITION BY empr_id ORDER BY nm) AS INT) AS nm_snum FROM name_found f WHERE nm_snum IS NULL""",
    "name_done": """SELECT empr_id, nm, nm_snum, 'F' AS name_ind FROM name_found WHERE nm_snum IS NOT NULL
 UNION ALL SELECT empr_id, nm, nm_snum, 'N' FROM name_new""",
    # addresses
    "addr_master": """SELECT empr_id, upper(trim(addr1)) AS addr1, upper(trim(city)) AS city, upper(trim(state)) AS state,
 upper(trim(zip5)) AS zip5, max(addr_snum) AS addr_snum FROM fx_addr GROUP BY 1, 2, 3, 4, 5""",
    "addr_in": """SELECT empr_id, a1 AS addr1, a2 AS city, a3 AS state, a4 AS zip5, count(*) AS n, min(input_order) AS first_id
 FROM reg GROUP BY 1, 2, 3, 4, 5""",
    "addr_found": """SELECT i.*, m.addr_snum FROM addr_in i LEFT JOIN addr_master m ON i.addr1 <> '' AND i.empr_id = m.empr_id
 AND i.addr1 = m.addr1 AND i.city = m.city AND i.state = m.state AND i.zip5 = m.zip5""",
    "addr_new": """SELECT empr_id, addr1, city, state, zip5, CAST(coalesce((SELECT max(addr_snum) FROM fx_addr x WHERE x.empr_id = f.empr_id), 0)
  + row_number() OVER (PARTITION BY empr_id ORDER BY first_id) AS INT) AS addr_snum FROM addr_found f WHERE addr_snum IS NULL""",
    "opt_in": """SELECT empr_id, o1 AS addr1, o2 AS city, o3 AS state, o4 AS zip5, count(*) AS n, min(input_order) AS first_id
 FROM reg WHERE o1 <> '' GROUP BY 1, 2, 3, 4, 5""",
    "opt_found": """SELECT i.*, m.addr_snum FROM opt_in i LEFT JOIN addr_master m USING (empr_id, addr1, city, state, zip5)""",
    "opt_open": """SELECT empr_id, addr1, city, state, zip5 FROM opt_found f WHERE addr_snum IS NULL AND NOT EXISTS (
 SELECT 1 FROM addr_new p WHERE p.empr_id = f.empr_id AND p.addr1 = f.addr1 AND p.city = f.city AND p.state = f.state AND p.zip5 = f.zip5)""",
    "opt_new": """SELECT empr_id, addr1, city, state, zip5, CAST(coalesce((SELECT max(addr_snum) FROM addr_new x WHERE x.empr_id = f.empr_id),
  (SELECT max(addr_snum) FROM fx_addr x WHERE x.empr_id = f.empr_id), 0)
  + row_number() OVER (PARTITION BY empr_id ORDER BY addr1, city, state, zip5) AS INT) AS addr_snum FROM opt_open f""",
    "id_flag": """SELECT empr_id, CASE WHEN empr_id IN (SELECT work_ein FROM rec WHERE cls = 'pseudo') THEN 'O'
  WHEN empr_id IN (SELECT empr_id FROM fx_name) THEN 'F' ELSE 'N' END AS table_ind
 FROM (SELECT DISTINCT empr_id FROM reg) i""",
    "linked": """SELECT empr_id, addr_snum, nm_snum, empr_nm FROM (SELECT k.empr_id, k.addr_snum, k.nm_snum, n.empr_nm,
  row_number() OVER (PARTITION BY k.empr_id, k.addr_snum ORDER BY k.nm_snum) AS rn
  FROM fx_link k JOIN fx_name n ON k.empr_id = n.empr_id AND k.nm_snum = n.nm_snum) x WHERE rn = 1""",
    # special ids
    "special_in": f"""SELECT empr_ein AS empr_idfr, {_SPECIAL_COLS}, min(input_order) AS first_id
 FROM rec WHERE cls = 'pseudo' GROUP BY empr_ein, {_SPECIAL_COLS}""",
    "special_no": _special(False),
    "special_no_reuse": _special(True),
    # outcome per record
    "reg_num": """SELECT r.*, coalesce(n.nm_snum, 0) AS np, coalesce(n.name_ind, ' ') AS ni, af.addr_snum AS a_known,
  coalesce(af.addr_snum, an.addr_snum) AS ap, af.first_id AS a_first, i.table_ind,
  fo.addr_snum AS o_known, fo.first_id AS o_first, coalesce(fo.addr_snum, op.addr_snum, onew.addr_snum, 0) AS op
 FROM reg r LEFT JOIN name_done n ON r.empr_id = n.empr_id AND r.nm = n.nm
 LEFT JOIN addr_found af ON r.empr_id = af.empr_id AND r.a1 = af.addr1 AND r.a2 = af.city AND r.a3 = af.state AND r.a4 = af.zip5
 LEFT JOIN addr_new an ON r.empr_id = an.empr_id AND r.a1 = an.addr1 AND r.a2 = an.city AND r.a3 = an.state AND r.a4 = an.zip5
 LEFT JOIN id_flag i ON r.empr_id = i.empr_id
 LEFT JOIN opt_found fo ON r.empr_id = fo.empr_id AND r.o1 = fo.addr1 AND r.o2 = fo.city AND r.o3 = fo.state AND r.o4 = fo.zip5
 LEFT JOIN addr_new op ON r.o1 <> '' AND r.empr_id = op.empr_id AND r.o1 = op.addr1 AND r.o2 = op.city AND r.o3 = op.state AND r.o4 = op.zip5
 LEFT JOIN opt_new onew ON r.empr_id = onew.empr_id AND r.o1 = onew.addr1 AND r.o2 = onew.city AND r.o3 = onew.state AND r.o4 = onew.zip5""",
    "outcome": """SELECT input_order, cls, 0 AS empr_name_pntr, 0 AS empr_addr_pntr, 0 AS empr_opt_addr_pntr, ' ' AS empr_table_ind,
  ' ' AS empr_name_ind, ' ' AS empr_addr_ind, ' ' AS empr_opt_addr_ind, empr_addr_inp_ind_cd, CAST(NULL AS VARCHAR) AS filled_name
 FROM rec WHERE cls = 'unknown'
 UNION ALL
 SELECT r.input_order, r.cls, 0, s.empr_snum, 0, 'O', ' ', CASE WHEN r.vald_ein_cd = 'I' THEN 'X' ELSE 'N' END, ' ', r.empr_addr_inp_ind_cd, NULL
 FROM rec r JOIN SPECIAL_NO s ON r.empr_ein = s.empr_idfr AND r.qw_employer_name = s.qw_employer_name AND r.addr1 = s.addr1
  AND r.addr2 = s.addr2 AND r.addr3 = s.addr3 AND r.city = s.city AND r.state = s.state AND r.zip5 = s.zip5 AND r.zip4 = s.zip4
 WHERE r.cls = 'pseudo'
 UNION ALL
 SELECT g.input_order, g.cls, CASE WHEN g.nm = '' AND l.nm_snum IS NOT NULL THEN l.nm_snum ELSE g.np END, g.ap, g.op, g.table_ind,
  CASE WHEN g.nm = '' AND l.nm_snum IS NOT NULL THEN 'R' ELSE g.ni END,
  CASE WHEN g.vald_ein_cd = 'I' THEN 'X' WHEN g.a_known IS NOT NULL THEN 'F' WHEN g.input_order = g.a_first THEN 'N' ELSE 'F' END,
  CASE WHEN g.o1 = '' THEN ' ' WHEN g.o_known IS NOT NULL THEN 'F' WHEN g.input_order = g.o_first THEN 'N' ELSE 'F' END,
  CASE WHEN g.a_known IS NOT NULL THEN 'F' ELSE 'N' END,
  CASE WHEN g.nm = '' THEN l.empr_nm END
 FROM reg_num g LEFT JOIN linked l ON g.empr_id = l.empr_id AND g.ap = l.addr_snum""",
    "done": """SELECT r.* REPLACE (coalesce(o.filled_name, r.qw_employer_name) AS qw_employer_name,
  o.empr_addr_inp_ind_cd AS empr_addr_inp_ind_cd), o.empr_name_pntr, o.empr_addr_pntr, o.empr_opt_addr_pntr,
  o.empr_table_ind, o.empr_name_ind, o.empr_addr_ind, o.empr_opt_addr_ind
 FROM rec r JOIN outcome o ON r.input_order = o.input_order""",
    "main": "SELECT * REPLACE (rpad(work_ein, 9, ' ') AS work_ein) FROM done",
    # change-sets
    "ch_name": _changes(
        f"""SELECT input_order, work_ein AS empr_id, empr_name_pntr AS nm_snum, qw_employer_name AS empr_nm,
 {ODATE} AS app_odate, CAST(NULL AS DATE) AS fcr_mtch_dt FROM main WHERE empr_table_ind <> 'O' AND empr_name_pntr > 0""",
        "fx_name",
        "empr_id, nm_snum",
    ),
    "ch_addr": _changes(
        f"""SELECT input_order, work_ein AS empr_id, empr_addr_pntr AS addr_snum, {_ADDR_OUT.format(p='')}
 FROM main WHERE empr_table_ind <> 'O' AND empr_addr_pntr > 0""",
        "fx_addr",
        "empr_id, addr_snum",
    ),
    "ch_opt": _changes(
        f"""SELECT input_order, work_ein AS empr_id, empr_opt_addr_pntr AS addr_snum, {_ADDR_OUT.format(p='opt_')}
 FROM main WHERE empr_table_ind <> 'O' AND empr_opt_addr_pntr > 0 AND trim(opt_addr1) <> ''""",
        "fx_addr",
        "empr_id, addr_snum",
        updates=False,
    ),
    "ch_special": _changes(
        f"""SELECT r.input_order, r.empr_ein AS empr_idfr, s.empr_snum, r.qw_employer_name AS empr_nm, {_ADDR_OUT.format(p='r.')}
 FROM rec r JOIN special_no_reuse s ON r.input_order = s.first_id""",
        "fx_special",
        "empr_idfr, empr_snum",
        guard=_GUARD,
    ),
}
CTES["ch_link"] = _changes(_links("", ", CAST(NULL AS DATE) AS certd_stdt"), "fx_link", _LINK_KEY)
CTES["ch_link_source"] = _changes(_links(", 'QW' AS prvdr_src_cd"), "fx_link_source", _LINK_KEY + ", prvdr_src_cd")
CTES["ch_link_type"] = _changes(_links(", 'PR' AS addr_typ_cd"), "fx_link_type", _LINK_KEY + ", addr_typ_cd")
# Optional addresses insert where no primary row changed the key.
CTES["ch_address"] = """SELECT * FROM ch_addr UNION ALL SELECT * FROM ch_opt o
 WHERE NOT EXISTS (SELECT 1 FROM ch_addr a WHERE a.empr_id = o.empr_id AND a.addr_snum = o.addr_snum)"""
CTES["outcome"] = CTES["outcome"].replace("SPECIAL_NO", "special_no")

_OUTCOME = (
    "input_order, empr_table_ind, empr_name_ind, empr_addr_ind, empr_opt_addr_ind, "
    "empr_name_pntr, empr_addr_pntr, empr_opt_addr_pntr"
)
_FOREIGN = [f for _, f, _ in FLAG_GUARDS]


_PLACE = """empr_addrln40_1 empr_addrln40_2 empr_addrln40_3 empr_city25 empr_st empr_zip5 empr_zip4 empr_frgn_cntry_cd
 empr_frgn_cntry_nm empr_frgnpzn addrck_pmycd addrck_scycd_1 addrck_scycd_2 app_odate""".split()
# Key and columns of each master, but the run's times.
_MASTERS = {
    "special": (2, ["empr_idfr", "empr_snum", "empr_nm", *_PLACE]),
    "name": (2, "empr_id nm_snum empr_nm app_odate fcr_mtch_dt".split()),
    "address": (2, ["empr_id", "addr_snum", *_PLACE]),
    "link": (3, "empr_id nm_snum addr_snum app_odate endt certd_stdt".split()),
    "link_source": (4, "empr_id nm_snum addr_snum prvdr_src_cd app_odate endt".split()),
    "link_type": (4, "empr_id nm_snum addr_snum addr_typ_cd app_odate endt".split()),
}


def _merge(table: str) -> str:
    """A master with its changes: dates of known rows, then new rows."""
    n, columns = _MASTERS[table]
    on = " AND ".join(f"m.{k} = c.{k}" for k in columns[:n])
    old = [f"CASE WHEN c.{columns[0]} IS NULL THEN m.app_odate ELSE {ODATE} END" if c == "app_odate" else f"m.{c}" for c in columns]
    updated = f"CASE WHEN c.{columns[0]} IS NULL THEN {STORED.format('m.lu_ts')} ELSE {RUN_TS} END"
    return f"""SELECT {", ".join(f"{o} AS {c}" for o, c in zip(old, columns))}, {STORED.format('m.insrt_ts')} AS insrt_ts, {updated} AS lu_ts
 FROM m_{table} m LEFT JOIN ch_{table} c ON c.db_oper_typ = 'U' AND {on}
 UNION ALL SELECT {", ".join(columns)}, {NEW_TIMES} FROM ch_{table} WHERE db_oper_typ = 'I'"""


def _numbers() -> str:
    """The highest number of each id in the three tables that number, after the changes."""
    keys = {"special": ("empr_idfr", "empr_snum"), "name": ("empr_id", "nm_snum"), "address": ("empr_id", "addr_snum")}
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {key} AS id, max({seq}) AS last FROM ({_merge(t)}) GROUP BY {key}" for t, (key, seq) in keys.items()
    )


def _with(body: str) -> str:
    """``body`` with the CTEs it needs, each after those it builds on."""
    wanted: list[str] = []

    def need(text: str) -> None:
        for name in CTES:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.append(name)
                need(CTES[name])

    need(body)
    # CTES is written in order of dependence.
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in wanted]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def _patched() -> str:
    span = (
        "o.empr_table_ind || o.empr_name_ind || lpad(CAST(o.empr_name_pntr AS VARCHAR), 10, '0') || o.empr_addr_ind"
        " || lpad(CAST(o.empr_addr_pntr AS VARCHAR), 10, '0') || o.empr_opt_addr_ind"
        " || lpad(CAST(o.empr_opt_addr_pntr AS VARCHAR), 10, '0')"
    )
    return (
        f"SELECT l.input_order, substr(l.value, 1, 383) || {span} || substr(l.value, 418) AS value"
        " FROM line l JOIN outcome o ON l.input_order = o.input_order"
    )


def _output() -> str:
    given = FX_COLUMNS | set(ALIASES) | {
        "empr_table_ind", "empr_name_ind", "empr_addr_ind", "empr_opt_addr_ind",
        "empr_name_pntr", "empr_addr_pntr", "empr_opt_addr_pntr",
    }

    def shaped(out: str, src: str) -> str:
        c = src if src in given else "''"
        if out == "file_rec_num_id":
            return f"TRY_CAST(trim({c}) AS INT) AS {out}"
        if out in _FOREIGN:
            return f"trim(coalesce({c}, '')) AS {out}"
        if out.endswith("_pntr") or out == "state_key_code":
            return f"{c} AS {out}"
        return f"trim({c}) AS {out}"

    return f"SELECT {', '.join(shaped(o, s) for o, s in OUTPUT)} FROM done"


def _bodies() -> dict[str, str]:
    fields = ", ".join(f"substr(value, {f.start}, {f.width}) AS {f.name}" for f in LAYOUT)
    guard_cols = ", ".join(
        f"CASE WHEN {g} = 'Y' THEN {f} END AS {f}, CASE WHEN {g} = 'Y' THEN {f} END AS {d}"
        for g, f, d in FLAG_GUARDS
    )
    code = f"CASE WHEN {BAD_ID} THEN 'I' ELSE vald_ein_cd END"
    return {
        "src_text": "SELECT value FROM line",
        "parse_fixed_width": f"SELECT input_order, {fields} FROM line",
        "valid_split": "SELECT input_order, value FROM feed WHERE length(value) > 1",
        "rejects": "SELECT value, 'EOF marker or empty record' AS reject_reason, CAST(length(value) AS INT) AS record_length"
        " FROM feed WHERE length(value) <= 1",
        "src_partitioned": "SELECT empr_id, addr_snum, 1 AS slices FROM fx_addr",
        "key_filter_semi": "SELECT * FROM fx_name WHERE empr_id IN (SELECT work_ein FROM rec WHERE cls = 'regular')",
        "stage_roundtrip": "SELECT input_order, cls, work_ein, qw_employer_name, addr1, empr_forgn_zip FROM rec",
        "patch_fixed_width": _patched(),
        "payload_rejoin": "SELECT r.input_order, r.cls, l.value FROM rec r JOIN line l ON r.input_order = l.input_order",
        "run_label": """SELECT o_orderkey, 'EMPLOYERS.SEQIDS' || CASE o_orderkey % 3
 WHEN 0 THEN '.R' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') || '.T' || lpad(CAST(o_orderkey % 240000 AS VARCHAR), 6, '0')
 WHEN 1 THEN '.R' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') || '.T000000'
 ELSE '.R240630.T000000' END AS label FROM orders""",
        "mask_invalid": f"""SELECT input_order, CASE WHEN ssn_val_code = 'I' THEN {_ZERO} ELSE wrk_ssn END AS wrk_ssn,
 CASE WHEN ssn_val_code = 'I' THEN {_ZERO} ELSE final_ssn END AS final_ssn FROM sub""",
        "validate_id": f"""SELECT input_order, {code} AS vald_ein_cd, CASE WHEN {BAD_ID} THEN '' ELSE final_empr_nm END AS final_empr_nm,
 CASE WHEN {BAD_ID} THEN '' ELSE wrk_empr_nm END AS wrk_empr_nm FROM sub""",
        "flag_guard": f"SELECT input_order, {guard_cols} FROM sub",
        "alias_project": f"SELECT input_order, {_ALIASES} FROM sub",
        "normalize": """SELECT input_order, upper(trim(qw_employer_name)) AS nm, upper(trim(qw_empr_address1)) AS addr1,
 upper(trim(qw_empr_city)) AS city, upper(trim(qw_empr_opt_address1)) AS opt_addr1 FROM sub""",
        "classify": "SELECT input_order, cls FROM rec",
        "unknown_out": f"SELECT {_OUTCOME}, cls, empr_addr_inp_ind_cd FROM outcome WHERE cls = 'unknown'",
        "addr_quality_code": f"SELECT input_order, {QUALITY} AS addrck_pmycd FROM sub",
        "scalar_functions": """SELECT input_order, substr(qw_employer_name, 3, 7) AS f_substring, substr(qw_employer_name, 60, 7) AS f_past_end,
 trim(qw_employer_name) AS f_trim, upper(qw_employer_name) AS f_upper, CAST(length(qw_employer_name) AS INT) AS f_length,
 lpad(empr_ein, 9, '0') AS f_lpad, rpad(empr_ein, 7, ' ') AS f_rpad, work_ein || '-' || qw_employer_name AS f_concat,
 regexp_matches(empr_ein, '^[0-9]{9}$') AS f_rlike, batch_number IN ('999999', '000002') AS f_isin,
 CASE WHEN ssn_val_code = 'I' THEN 'bad' ELSE 'good' END AS f_when, coalesce(nullif(qw_employer_name, ''), 'none') AS f_coalesce,
 CAST(least(length(qw_employer_name), length(empr_ein)) AS INT) AS f_least,
 CAST(greatest(length(qw_employer_name), length(empr_ein)) AS INT) AS f_greatest,
 nullif(qw_employer_name, '') IS NULL AS f_is_null, DATE '2024-06-30' AS f_date, TRY_CAST(trim(file_rec_num_id) AS INT) AS f_int,
 CAST(input_order AS VARCHAR) AS f_string, input_order * 2 + 1 AS f_arithmetic,
 NOT (batch_number = '999999') AND length(qw_employer_name) > 4 AS f_logic,
 regexp_extract(qw_employer_name, '([0-9]+)', 1) AS f_regexp FROM sub""",
        "distinct_keys": """SELECT DISTINCT 'run' AS key_set, work_ein AS id FROM rec
 UNION ALL SELECT DISTINCT 'special_column', empr_ein FROM rec
 UNION ALL SELECT DISTINCT 'regular', work_ein FROM rec WHERE cls = 'regular'
 UNION ALL SELECT DISTINCT 'pseudo', work_ein FROM rec WHERE cls = 'pseudo'
 UNION ALL SELECT DISTINCT 'master', empr_id FROM fx_name""",
        "max_seq": """SELECT 'fx_name' AS table_name, empr_id AS id, max(nm_snum) AS last FROM fx_name GROUP BY empr_id
 UNION ALL SELECT 'fx_addr', empr_id, max(addr_snum) FROM fx_addr GROUP BY empr_id
 UNION ALL SELECT 'fx_special', empr_idfr, max(empr_snum) FROM fx_special GROUP BY empr_idfr""",
        "dedup_first": "SELECT first_id AS input_order, empr_idfr, qw_employer_name, addr1 FROM special_in",
        "run_summary": """SELECT cls, count(*) AS records FROM rec WHERE input_order % 1000 NOT IN (7, 8) GROUP BY cls
 UNION ALL SELECT 'lines', count(*) FROM feed UNION ALL SELECT 'rejected', count(*) FROM feed WHERE length(value) <= 1""",
        "conservation_check": """SELECT (SELECT count(*) FROM rec) AS rows_before, (SELECT count(*) FROM outcome) AS rows_after,
 (SELECT count(*) FROM rec WHERE input_order NOT IN (SELECT input_order FROM outcome)) AS missing,
 (SELECT count(*) FROM outcome WHERE input_order NOT IN (SELECT input_order FROM rec)) AS added,
 (SELECT count(*) FROM (SELECT input_order FROM outcome GROUP BY 1 HAVING count(*) > 1) x) AS repeated""",
        "align_union": """SELECT input_order, cls, 0 AS empr_name_pntr, 0 AS empr_addr_pntr, 0 AS empr_opt_addr_pntr,
 CASE WHEN cls = 'pseudo' THEN 'O' ELSE ' ' END AS empr_table_ind, ' ' AS empr_name_ind, ' ' AS empr_addr_ind, ' ' AS empr_opt_addr_ind,
 CASE WHEN cls <> 'regular' THEN empr_addr_inp_ind_cd END AS empr_addr_inp_ind_cd,
 CASE WHEN cls = 'regular' THEN qw_empr_forgn_cc END AS qw_empr_forgn_cc FROM rec""",
        "exact_name": "SELECT empr_id, nm, nm_snum, name_ind FROM exact",
        "fuzzy_candidates": "SELECT empr_id, nm, master_nm, nm_snum, round(score, 6) AS score FROM scored",
        "best_fuzzy": """SELECT empr_id, nm, master_nm, nm_snum, round(score, 6) AS score FROM (
 SELECT *, rank() OVER (PARTITION BY empr_id, nm ORDER BY score DESC) AS rk FROM scored) x WHERE rk = 1""",
        "new_name_seq": "SELECT empr_id, nm, nm_snum FROM name_new",
        "name_resolution": "SELECT input_order, np AS empr_name_pntr, ni AS empr_name_ind FROM reg_num",
        "backfill_names": "SELECT input_order, empr_addr_pntr, empr_name_pntr, filled_name FROM outcome WHERE empr_name_ind = 'R'",
        "addr_dedup_latest": "SELECT empr_id, addr1, city, state, zip5, addr_snum FROM addr_master",
        "addr_match": "SELECT empr_id, addr1, city, state, zip5, n, first_id, addr_snum FROM addr_found",
        "new_addr_seq": "SELECT empr_id, addr1, city, state, zip5, addr_snum FROM addr_new",
        "addr_resolution": "SELECT input_order, empr_addr_pntr, empr_addr_ind, empr_addr_inp_ind_cd FROM outcome WHERE cls = 'regular'",
        "opt_addr_match": "SELECT empr_id, addr1, city, state, zip5, n, first_id, addr_snum FROM opt_found",
        "new_opt_addr": "SELECT empr_id, addr1, city, state, zip5 FROM opt_open",
        "new_opt_seq": "SELECT empr_id, addr1, city, state, zip5, addr_snum FROM opt_new",
        "opt_resolution": "SELECT input_order, empr_opt_addr_pntr, empr_opt_addr_ind FROM outcome WHERE cls = 'regular'",
        "table_indicator": "SELECT empr_id, table_ind FROM id_flag",
        "special_seq": f"SELECT empr_idfr, {_SPECIAL_COLS}, first_id, empr_snum FROM special_no",
        "special_resolution": "SELECT input_order, empr_addr_pntr, empr_table_ind, empr_addr_ind, empr_addr_inp_ind_cd FROM outcome WHERE cls = 'pseudo'",
        "indicators": f"SELECT {_OUTCOME} FROM outcome",
        "main_tmp": f"SELECT input_order, {', '.join(MAIN_COLUMNS)} FROM main",
        "enriched_output": _output(),
        "cs_special": f"SELECT *, {NEW_TIMES} FROM ch_special",
        "cs_name": f"SELECT *, {NEW_TIMES} FROM ch_name",
        "cs_addr": f"SELECT *, {NEW_TIMES} FROM ch_addr",
        "cs_opt_addr": f"SELECT *, {NEW_TIMES} FROM ch_opt",
        "cs_link": f"SELECT *, {NEW_TIMES} FROM ch_link",
        "cs_link_source": f"SELECT *, {NEW_TIMES} FROM ch_link_source",
        "cs_link_type": f"SELECT *, {NEW_TIMES} FROM ch_link_type",
        "merge_update": f"""SELECT n.* REPLACE (CASE WHEN c.empr_id IS NOT NULL THEN {ODATE} ELSE n.app_odate END AS app_odate,
 CASE WHEN c.empr_id IS NOT NULL THEN {RUN_TS} ELSE {STORED.format('n.lu_ts')} END AS lu_ts, {STORED.format('n.insrt_ts')} AS insrt_ts)
 FROM m_name n LEFT JOIN ch_name c ON c.db_oper_typ = 'U' AND n.empr_id = c.empr_id AND n.nm_snum = c.nm_snum""",
        "merge_insert": f"""SELECT {', '.join(_MASTERS['address'][1])}, {STORED.format('insrt_ts')} AS insrt_ts,
 {STORED.format('lu_ts')} AS lu_ts FROM m_address
 UNION ALL SELECT {', '.join(_MASTERS['address'][1])}, {NEW_TIMES} FROM ch_address WHERE db_oper_typ = 'I'""",
        **{f"merge_{t}": _merge(t) for t in _MASTERS},
        "numbers_in_use": _numbers(),
    }


# Queries that reach the same rows another way.
SAME_ROWS = {"key_filter_buckets": "key_filter_semi", "merge_by_bucket": "merge_name"}


def statements() -> dict[str, str]:
    bodies = _bodies()
    bodies |= {name: bodies[like] for name, like in SAME_ROWS.items()}
    return {name: _with(body) for name, body in bodies.items()}
