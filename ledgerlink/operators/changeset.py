"""Insert / update change-sets against the master tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.config import MatchConfig
from ledgerlink.functions.normalize import is_blank, norm, quality_code
from ledgerlink.operators.classify import PSEUDO
from ledgerlink.operators.keyed import keep_first, shuffled_side


@dataclass(frozen=True)
class TableSpec:
    """A master table: its key, its other columns, and those that must agree before a row is updated."""

    name: str
    key: tuple[str, ...]
    rest: tuple[str, ...]
    guard: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.key, *self.rest)

    def of(self, master: DataFrame) -> DataFrame:
        """The master with just the columns of the table; an error if one is missing."""
        if missing := [c for c in self.columns if c not in master.columns]:
            raise ValueError(f"table {self.name} has no column {', '.join(missing)}")
        return master.select(*self.columns)


# Stored column names and codes.
# Incoming column (after its prefix) and the master's name for it.
ADDRESS_COLUMNS = {
    "addr1": "empr_addrln40_1",
    "addr2": "empr_addrln40_2",
    "addr3": "empr_addrln40_3",
    "city": "empr_city25",
    "state": "empr_st",
    "zip5": "empr_zip5",
    "zip4": "empr_zip4",
}
FOREIGN_COLUMNS = {
    "empr_forgn_cc": "empr_frgn_cntry_cd",
    "empr_forgn_c_name": "empr_frgn_cntry_nm",
    "empr_forgn_zip": "empr_frgnpzn",
}
LINK_KEY = ("empr_id", "nm_snum", "addr_snum")
SOURCE_CODE, ADDRESS_TYPE = "QW", "PR"

QUALITY_COLUMNS = ("addrck_pmycd", "addrck_scycd_1", "addrck_scycd_2")
PLACE_COLUMNS = (*ADDRESS_COLUMNS.values(), *FOREIGN_COLUMNS.values(), *QUALITY_COLUMNS)
STAMPS = ("app_odate", "insrt_ts", "lu_ts")

SPECIAL = TableSpec(
    "special",
    ("empr_idfr", "empr_snum"),
    ("empr_nm", *PLACE_COLUMNS, *STAMPS),
    ("empr_nm", *ADDRESS_COLUMNS.values()),
)
NAME = TableSpec("name", ("empr_id", "nm_snum"), ("empr_nm", *STAMPS, "fcr_mtch_dt"))
ADDRESS = TableSpec("address", ("empr_id", "addr_snum"), (*PLACE_COLUMNS, *STAMPS))
LINK = TableSpec("link", LINK_KEY, (*STAMPS, "endt", "certd_stdt"))
LINK_SOURCE = TableSpec("link_source", (*LINK_KEY, "prvdr_src_cd"), (*STAMPS, "endt"))
LINK_TYPE = TableSpec("link_type", (*LINK_KEY, "addr_typ_cd"), (*STAMPS, "endt"))
TABLES = (SPECIAL, NAME, ADDRESS, LINK, LINK_SOURCE, LINK_TYPE)


def address_view(master: DataFrame) -> DataFrame:
    """An address master under the column names the matching steps use."""
    return master.withColumnsRenamed({m: c for c, m in ADDRESS_COLUMNS.items()})


def _stamped(cfg: MatchConfig) -> list[Column]:
    return [
        F.lit(cfg.odate).alias("app_odate"),
        F.lit(cfg.run_ts).alias("insrt_ts"),
        F.lit(cfg.run_ts).alias("lu_ts"),
    ]


def _address_part(prefix: str = "") -> list[Column]:
    return [
        *[F.col(prefix + c).alias(m) for c, m in ADDRESS_COLUMNS.items()],
        *[F.col(prefix + c).alias(m) for c, m in FOREIGN_COLUMNS.items()],
        quality_code(F.col("fnl_empr_err_tab")).alias("addrck_pmycd"),
        F.lit("").alias("addrck_scycd_1"),
        F.lit("").alias("addrck_scycd_2"),
    ]


def _regular(main: DataFrame, *pointers: str) -> DataFrame:
    """Rows that may change the master: a number for each part, and not a special id."""
    rows = main.filter(F.col("empr_table_ind") != "O")
    for p in pointers:
        rows = rows.filter(F.col(p) > 0)
    return rows


def _no_date(name: str) -> Column:
    return F.lit(None).cast("date").alias(name)


# Every source below also carries the record id, which decides between equal keys.


def special_rows(main: DataFrame, cfg: MatchConfig) -> DataFrame:
    return main.filter((F.col("cls") == PSEUDO) & (F.col("empr_addr_pntr") > 0)).select(
        cfg.record_id,
        F.coalesce(cfg.special_id, F.lit("")).alias("empr_idfr"),
        F.col("empr_addr_pntr").alias("empr_snum"),
        F.col("qw_employer_name").alias("empr_nm"),
        *_address_part(),
        *_stamped(cfg),
    )


def name_rows(main: DataFrame, cfg: MatchConfig) -> DataFrame:
    return _regular(main, "empr_name_pntr").select(
        cfg.record_id,
        F.col("work_ein").alias("empr_id"),
        F.col("empr_name_pntr").alias("nm_snum"),
        F.col("qw_employer_name").alias("empr_nm"),
        *_stamped(cfg),
        _no_date("fcr_mtch_dt"),
    )


def address_rows(main: DataFrame, cfg: MatchConfig) -> DataFrame:
    return _regular(main, "empr_addr_pntr").select(
        cfg.record_id,
        F.col("work_ein").alias("empr_id"),
        F.col("empr_addr_pntr").alias("addr_snum"),
        *_address_part(),
        *_stamped(cfg),
    )


def optional_address_rows(main: DataFrame, cfg: MatchConfig) -> DataFrame:
    rows = _regular(main, "empr_opt_addr_pntr").filter(~is_blank(F.col("opt_addr1")))
    return rows.select(
        cfg.record_id,
        F.col("work_ein").alias("empr_id"),
        F.col("empr_opt_addr_pntr").alias("addr_snum"),
        *_address_part("opt_"),
        *_stamped(cfg),
    )


def link_rows(main: DataFrame, cfg: MatchConfig) -> DataFrame:
    return _regular(main, "empr_name_pntr", "empr_addr_pntr").select(
        cfg.record_id,
        F.col("work_ein").alias("empr_id"),
        F.col("empr_addr_pntr").alias("addr_snum"),
        F.col("empr_name_pntr").alias("nm_snum"),
        *_stamped(cfg),
        _no_date("endt"),
        _no_date("certd_stdt"),
    )


def link_source_rows(links: DataFrame) -> DataFrame:
    return links.drop("certd_stdt").withColumn("prvdr_src_cd", F.lit(SOURCE_CODE))


def link_type_rows(links: DataFrame) -> DataFrame:
    return links.drop("certd_stdt").withColumn("addr_typ_cd", F.lit(ADDRESS_TYPE))


def deciding_records(outcome: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Ids of the records that change-sets can take rows from: the first of each number of an id, and of each link.

    Found from the numbers alone, by minima that are aggregated before the shuffle; no record is sorted, nothing of its
    text is read. Change-sets of these records and of all records are the same.
    """
    rid, pseudo = cfg.record_id, F.col("cls") == PSEUDO
    name, addr, opt = F.col("empr_name_pntr"), F.col("empr_addr_pntr"), F.col("empr_opt_addr_pntr")
    numbered = outcome.filter((pseudo & (addr > 0)) | ((F.col("empr_table_ind") != "O") & ((name > 0) | (addr > 0) | (opt > 0))))
    # Records of one id mostly repeat a few combinations, so these come first.
    together = numbered.groupBy(pseudo.alias("_pseudo"), "master_id", name.alias("_name"), addr.alias("_addr"), opt.alias("_opt"))
    together = together.agg(F.min(rid).alias(rid))
    name, addr, opt = (F.col(c).cast("long") for c in ("_name", "_addr", "_opt"))
    pseudo, none = F.col("_pseudo"), F.lit(0).cast("long")
    kinds = [  # special, name, address, optional address, link: the numbers each has of a record, if any
        (F.when(pseudo & (addr > 0), addr), none),
        (F.when(~pseudo & (name > 0), name), none),
        (F.when(~pseudo & (addr > 0), addr), none),
        (F.when(~pseudo & (opt > 0), opt), none),
        (F.when(~pseudo & (name > 0) & (addr > 0), name), addr),
    ]
    rows = [x for kind, numbers in enumerate(kinds) for x in (F.lit(kind), *numbers)]
    each = together.select(rid, "master_id", F.stack(F.lit(len(kinds)), *rows).alias("kind", "a", "b")).filter("a IS NOT NULL")
    firsts = each.groupBy("kind", "master_id", "a", "b").agg(F.min(rid).alias(rid))
    return firsts.select(rid).distinct()


def change_set(
    src: DataFrame, master: DataFrame, spec: TableSpec, cfg: MatchConfig, no_update: str | None = None
) -> DataFrame:
    """``I`` for new keys, ``U`` for known ones last seen on another date.

    One row per key, taken from the lowest record id. A master row without a date, or
    one whose guard columns differ, gives no row. ``no_update`` names a flag of rows that may only
    insert; others of their key go before them.
    """
    order = [F.col(c) for c in (no_update, cfg.record_id) if c]
    first = keep_first(src, spec.key, order).drop(cfg.record_id)
    known = master.select(
        *spec.key,
        F.lit(True).alias("_known"),
        F.col("app_odate").alias("_seen"),
        *[norm(F.col(c)).alias(f"_{c}") for c in spec.guard],
    )
    stale = F.col("_seen") != F.lit(cfg.odate)
    for c in spec.guard:
        stale = stale & (norm(F.col(c)) == F.col(f"_{c}"))
    if no_update:
        stale = stale & ~F.col(no_update)
    op = F.when(F.col("_known").isNull(), "I").when(stale, "U")
    columns = [c for c in first.columns if c != no_update]
    zero = F.lit(0).cast("long")
    return (
        first.join(shuffled_side(known), list(spec.key), "left")
        .withColumn("db_oper_typ", op)
        .filter(F.col("db_oper_typ").isNotNull())
        .select("db_oper_typ", zero.alias("db_sort_num"), zero.alias("db_uid"), *columns)
    )


def address_changes(main: DataFrame, master: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Primary and optional addresses in one pass; a shared number counts once, as a primary one."""
    primary = address_rows(main, cfg).withColumn("_optional", F.lit(False))
    optional = optional_address_rows(main, cfg).withColumn("_optional", F.lit(True))
    return change_set(primary.unionByName(optional), master, ADDRESS, cfg, no_update="_optional")
