"""Submissions and master tables derived from the whole test tables.

The texts below run unchanged in Spark SQL and in DuckDB. One order is one wage record,
its customer the employer. Fifteen customers share an employer id, so ids, names and
addresses grow with the tables, and no row is left out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.operators.keyed import shuffled_side
from ledgerlink.staging import stage, together

BASE_TABLES = ("orders", "customer", "nation", "part")
# The columns used of the tables that grow.
DEALT = {
    "orders": ("o_orderkey", "o_custkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
    "part": ("p_partkey", "p_name", "p_type", "p_size"),
}

# Master name of an employer, and the id block of a key.
_NAME = "concat(p.p_name, ' ', p.p_type, ' ', CAST(p.p_size AS STRING))"


def _block(key: str) -> str:
    return f"CAST(CAST(floor({key} / 15) AS BIGINT) AS STRING)"


_SUB_BASE = f"""
SELECT o.o_orderkey AS r, c.c_custkey AS k, c.c_name AS cname, c.c_mktsegment AS seg,
  n.n_name AS nation, lpad(CAST(c.c_nationkey AS STRING), 5, '0') AS nzip,
  lpad({_block('c.c_custkey')}, 9, '9') AS eid,
  {_NAME} AS bn,
  CASE WHEN o.o_orderkey % 50 = 7 THEN concat('A', lpad({_block('c.c_custkey')}, 8, '0'))
       WHEN o.o_orderkey % 47 = 5 THEN concat(lpad(CAST(c.c_nationkey AS STRING), 2, '1'), '0000000')
  END AS sp
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON p.p_partkey = c.c_custkey
"""

# One record per order, under the field names of the record layout.
SUB = f"""
SELECT r AS input_order,
  'QWFILE' AS file_name,
  CASE WHEN r % 59 = 8 THEN 'BAD' ELSE lpad(CAST(r AS STRING), 10, '0') END AS file_rec_num_id,
  CASE WHEN sp IS NOT NULL AND k % 105 <> 4 THEN sp ELSE eid END AS work_ein,
  coalesce(sp, CASE WHEN r % 53 = 3 THEN '12345' ELSE eid END) AS empr_ein,
  CASE WHEN r % 101 = 9 THEN 'AB' ELSE
    CASE r % 8 WHEN 0 THEN bn WHEN 1 THEN concat('  ', upper(bn), ' ') WHEN 2 THEN concat(bn, 's')
      WHEN 3 THEN concat(bn, ' co') WHEN 4 THEN substr(bn, 2, 40)
      WHEN 5 THEN CASE WHEN r % 16 = 5 THEN '' ELSE bn END
      WHEN 6 THEN concat(cname, ' LTD') ELSE lower(bn) END END AS qw_employer_name,
  bn AS final_empr_nm, bn AS wrk_empr_nm,
  CASE WHEN r % 40 = 21 THEN '' WHEN r % 11 = 3 THEN concat('SUITE ', CAST(r % 5 AS STRING), ' ', seg, ' AVE')
    ELSE concat(CAST(k % 1009 AS STRING), ' ', CASE WHEN r % 2 = 0 THEN lower(seg) ELSE seg END, ' ST') END AS qw_empr_address1,
  CASE WHEN k % 3 = 0 THEN 'FLOOR 2' ELSE '' END AS qw_empr_address2, '' AS qw_empr_address3,
  nation AS qw_empr_city, substr(nation, 1, 2) AS qw_empr_state, nzip AS qw_empr_zip_5,
  lpad(CAST(k % 10000 AS STRING), 4, '0') AS qw_empr_zip_4,
  CASE WHEN r % 6 = 0 THEN concat(CAST(k % 1009 AS STRING), ' ', seg, ' st')
    WHEN r % 6 = 3 THEN CASE WHEN r % 4 = 1 THEN concat('SUITE ', CAST(r % 5 AS STRING), ' ', seg, ' AVE')
      ELSE concat('PO BOX ', CAST(r % 13 AS STRING)) END ELSE '' END AS qw_empr_opt_address1,
  '' AS qw_empr_opt_address2, '' AS qw_empr_opt_address3,
  CASE WHEN r % 3 = 0 THEN nation ELSE '' END AS qw_empr_opt_city,
  CASE WHEN r % 3 = 0 THEN substr(nation, 1, 2) ELSE '' END AS qw_empr_opt_state,
  CASE WHEN r % 3 = 0 THEN nzip ELSE '' END AS qw_empr_opt_zip_5, '' AS qw_empr_opt_zip_4,
  CASE WHEN r % 97 = 11 THEN '999999' ELSE '000001' END AS batch_number,
  CASE WHEN r % 211 = 50 THEN 'Y' ELSE 'N' END AS is_batch_num_999999_test,
  CASE WHEN r % 24 = 5 THEN 'X' ELSE 'N' END AS empr_addr_ind_input,
  CASE WHEN r % 31 = 1 THEN 'I' ELSE 'Y' END AS ssn_val_code, 'Y' AS vald_ein_cd,
  lpad(CAST(r AS STRING), 9, '0') AS wrk_ssn, lpad(CAST(r AS STRING), 9, '1') AS final_ssn,
  CASE WHEN r % 29 = 2 THEN 'Y' ELSE 'N' END AS qw_frgn_empr_flg_cc,
  CASE WHEN r % 29 < 4 THEN 'Y' ELSE '' END AS qw_frgn_empr_flg_cname,
  CASE WHEN r % 29 = 3 THEN 'Y' ELSE 'N' END AS qw_frgn_empr_flg_czip,
  CASE WHEN r % 37 = 2 THEN 'Y' ELSE 'N' END AS qw_frgn_opt_flg_cc,
  CASE WHEN r % 37 < 4 THEN 'Y' ELSE 'N' END AS qw_frgn_opt_flg_cname,
  CASE WHEN r % 37 = 3 THEN 'Y' ELSE 'N' END AS qw_frgn_opt_flg_czip,
  'CA' AS qw_empr_forgn_cc, 'CANADA' AS qw_empr_forgn_c_name, concat('K', nzip) AS qw_empr_forgn_zip,
  'MX' AS qw_er_opt_frn_cc, 'MEXICO' AS qw_er_opt_frn_c_name, concat('M', nzip) AS qw_er_opt_frn_zip,
  CASE r % 4 WHEN 0 THEN 'G01' WHEN 1 THEN 'C1' WHEN 2 THEN 'X' ELSE '' END AS fnl_empr_err_tab,
  concat(substr(nation, 1, 2), lpad(CAST(k % 10000 AS STRING), 7, '0')) AS state_key_code_full,
  substr(nation, 1, 2) AS state_key_code,
  lpad(CAST(r % 1000000 AS STRING), 11, '0') AS wrk_wage_amt_x
FROM ({_SUB_BASE}) b
"""

FX_NAME = f"""
SELECT empr_id, empr_nm, nm_snum,
  CASE WHEN nm_snum % 7 = 2 THEN NULL WHEN nm_snum % 3 = 0 THEN DATE '2024-06-30' ELSE DATE '2024-03-31' END AS app_odate
FROM (SELECT empr_id, empr_nm, CAST(row_number() OVER (PARTITION BY empr_id ORDER BY empr_nm) AS INT) AS nm_snum
  FROM (SELECT DISTINCT lpad({_block('p.p_partkey')}, 9, '9') AS empr_id, {_NAME} AS empr_nm FROM part p) a) b
"""

# Every customer's address, stored once as it is and once in lower case.
FX_ADDR = f"""
SELECT empr_id, addr1, city, state, zip5, addr_snum,
  CASE WHEN addr_snum % 2 = 0 THEN DATE '2024-06-30' ELSE DATE '2024-03-31' END AS app_odate
FROM (SELECT empr_id, addr1, city, state, zip5,
    CAST(row_number() OVER (PARTITION BY empr_id ORDER BY addr1, city) AS INT) AS addr_snum
  FROM (SELECT lpad({_block('c.c_custkey')}, 9, '9') AS empr_id,
      concat(CAST(c.c_custkey % 1009 AS STRING), ' ', c.c_mktsegment, ' ST') AS addr1, n.n_name AS city,
      substr(n.n_name, 1, 2) AS state, lpad(CAST(c.c_nationkey AS STRING), 5, '0') AS zip5
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    UNION
    SELECT lpad({_block('c.c_custkey')}, 9, '9') AS empr_id,
      lower(concat(CAST(c.c_custkey % 1009 AS STRING), ' ', c.c_mktsegment, ' ST')) AS addr1, n.n_name AS city,
      substr(n.n_name, 1, 2) AS state, lpad(CAST(c.c_nationkey AS STRING), 5, '0') AS zip5
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) a) b
"""



def _link(names: str, addresses: str) -> str:
    return f"""
SELECT n.empr_id, n.nm_snum, a.addr_snum,
  CASE WHEN (n.nm_snum + a.addr_snum) % 4 = 1 THEN DATE '2024-06-30' ELSE DATE '2024-03-31' END AS app_odate
FROM {names} n JOIN {addresses} a ON n.empr_id = a.empr_id AND n.nm_snum IN (a.addr_snum - 5, a.addr_snum - 9, a.addr_snum - 14)
"""


def _link_source(link: str) -> str:
    return f"SELECT empr_id, nm_snum, addr_snum, 'QW' AS prvdr_src_cd, app_odate FROM {link} k"


def _link_type(link: str) -> str:
    return f"SELECT empr_id, nm_snum, addr_snum, 'PR' AS addr_typ_cd, app_odate FROM {link} k"


FX_LINK = _link(f"({FX_NAME})", f"({FX_ADDR})")
FX_LINK_SOURCE, FX_LINK_TYPE = _link_source(f"({FX_LINK})"), _link_type(f"({FX_LINK})")

# Special-id addresses: every customer's own name and address under its block's id.
FX_SPECIAL = f"""
SELECT empr_idfr, CAST(row_number() OVER (PARTITION BY empr_idfr ORDER BY k) AS INT) AS empr_snum,
  empr_nm, empr_addrln40_1, empr_addrln40_2, empr_addrln40_3, empr_city25, empr_st, empr_zip5, empr_zip4,
  CASE WHEN k % 3 = 1 THEN DATE '2024-06-30' ELSE DATE '2024-03-31' END AS app_odate
FROM (SELECT c.c_custkey AS k, concat('A', lpad({_block('c.c_custkey')}, 8, '0')) AS empr_idfr,
    upper({_NAME}) AS empr_nm,
    concat(CAST(c.c_custkey % 1009 AS STRING), ' ', c.c_mktsegment, ' ST') AS empr_addrln40_1,
    CASE WHEN c.c_custkey % 3 = 0 THEN 'FLOOR 2' ELSE '' END AS empr_addrln40_2, '' AS empr_addrln40_3,
    n.n_name AS empr_city25, substr(n.n_name, 1, 2) AS empr_st,
    lpad(CAST(c.c_nationkey AS STRING), 5, '0') AS empr_zip5,
    lpad(CAST(c.c_custkey % 10000 AS STRING), 4, '0') AS empr_zip4
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON p.p_partkey = c.c_custkey) a
"""

# The masters as they are stored, with every column of their tables.
_STAMPS = "TIMESTAMP '2023-01-01 00:00:00' AS insrt_ts, TIMESTAMP '2023-06-01 00:00:00' AS lu_ts"


def _foreign(by: str) -> str:
    return f"""CASE WHEN {by} % 9 = 0 THEN 'CA' END AS empr_frgn_cntry_cd, CASE WHEN {by} % 9 = 0 THEN 'CANADA' END AS empr_frgn_cntry_nm,
  CASE WHEN {by} % 9 = 0 THEN concat('K', CAST({by} AS STRING)) END AS empr_frgnpzn,
  CASE {by} % 3 WHEN 0 THEN 'GA' WHEN 1 THEN 'CH' ELSE 'BA' END AS addrck_pmycd,
  CASE WHEN {by} % 4 = 0 THEN 'S1' ELSE '' END AS addrck_scycd_1, '' AS addrck_scycd_2"""


M_NAME = f"""SELECT empr_id, nm_snum, empr_nm, app_odate, {_STAMPS},
  CASE WHEN nm_snum % 5 = 1 THEN DATE '2022-02-02' END AS fcr_mtch_dt FROM ({FX_NAME}) n"""
M_ADDR = f"""SELECT empr_id, addr_snum, addr1 AS empr_addrln40_1, CASE WHEN addr_snum % 4 = 1 THEN 'FLOOR 3' ELSE '' END AS empr_addrln40_2,
  '' AS empr_addrln40_3, city AS empr_city25, state AS empr_st, zip5 AS empr_zip5, lpad(CAST(addr_snum AS STRING), 4, '0') AS empr_zip4,
  {_foreign('addr_snum')}, app_odate, {_STAMPS} FROM ({FX_ADDR}) a"""


def _m_link(link: str) -> str:
    return f"""SELECT k.*, {_STAMPS}, CASE WHEN nm_snum % 6 = 1 THEN DATE '2024-01-31' END AS endt,
  CASE WHEN nm_snum % 6 = 2 THEN DATE '2020-01-31' END AS certd_stdt FROM ({link}) k"""


def _m_link_part(link: str) -> str:
    return f"SELECT k.*, {_STAMPS}, CASE WHEN nm_snum % 6 = 1 THEN DATE '2024-01-31' END AS endt FROM ({link}) k"


M_LINK, M_LINK_SOURCE, M_LINK_TYPE = _m_link(FX_LINK), _m_link_part(FX_LINK_SOURCE), _m_link_part(FX_LINK_TYPE)
M_SPECIAL = f"SELECT s.*, {_foreign('empr_snum')}, {_STAMPS} FROM ({FX_SPECIAL}) s"

VIEWS = {
    "sub": SUB,
    "fx_name": FX_NAME,
    "fx_addr": FX_ADDR,
    "fx_link": FX_LINK,
    "fx_link_source": FX_LINK_SOURCE,
    "fx_link_type": FX_LINK_TYPE,
    "fx_special": FX_SPECIAL,
    "m_name": M_NAME,
    "m_address": M_ADDR,
    "m_special": M_SPECIAL,
    "m_link": M_LINK,
    "m_link_source": M_LINK_SOURCE,
    "m_link_type": M_LINK_TYPE,
}


def frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The fixture views over the tables in ``sf_dir``; the session's own views stay as they are."""
    named = {}
    for t in BASE_TABLES:
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        if used := DEALT.get(t):
            # Each table is one small file: deal it out, as a large one would be.
            df = df.select(*used).repartition(spark.sparkContext.defaultParallelism)
        named[t] = df

    # The side a join looks up: 25 nations are sent whole. The others grow; Spark would send them by the size of their files.
    sides = {f"{t}_side": F.broadcast(df) if t == "nation" else df.hint("shuffle_hash") for t, df in named.items()}

    def over(text: str) -> DataFrame:
        for t in BASE_TABLES:
            text = re.sub(rf"\bFROM {t} ", f"FROM {{{t}}} ", text)
            text = re.sub(rf"\bJOIN {t} ", f"JOIN {{{t}_side}} ", text)
        return spark.sql(text, **named, **sides)

    return {**named, **{name: over(text) for name, text in VIEWS.items()}}


def stored_masters(fx: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The ``m_`` views, written once each. Those of links are derived from the stored names and addresses."""
    spark = fx["m_name"].sparkSession
    names = ("m_name", "m_address", "m_special")
    kept = dict(zip(names, together(spark, *[lambda name=name: stage(fx[name], name) for name in names])))
    kept["fx_link"] = stage(spark.sql(_link("{names}", "{addresses}"), names=kept["m_name"], addresses=shuffled_side(kept["m_address"])), "fx_link")
    texts = {"m_link": _m_link("SELECT * FROM {link}"), "m_link_source": _m_link_part(_link_source("{link}")), "m_link_type": _m_link_part(_link_type("{link}"))}
    return kept | {name: spark.sql(text, link=kept["fx_link"]) for name, text in texts.items()}
