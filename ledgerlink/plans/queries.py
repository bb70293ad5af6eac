"""One query per operator, over the fixture views."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.config import MatchConfig
from ledgerlink.functions.normalize import key, norm, quality_code
from ledgerlink.operators import addresses as ad
from ledgerlink.operators import assemble as asm
from ledgerlink.operators import changeset as cs
from ledgerlink.operators import classify as cl
from ledgerlink.operators import keyed, merge, names, numbering, special
from ledgerlink.plans import enrich as en
from ledgerlink.plans import fixtures
from ledgerlink.sources import intake, layout, publish, tables
from ledgerlink.staging import stage, stage_path, together

CFG = MatchConfig(odate=date(2024, 6, 30), run_ts=datetime(2024, 6, 30))
TIMES = ("insrt_ts", "lu_ts")


class Case:
    """The fixtures of one query, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: MatchConfig = CFG):
        self.spark, self.cfg = spark, cfg
        self.fx = fixtures.frames(spark, sf_dir)

    def scratch(self, name: str) -> str:
        return stage_path(self.spark, name)

    @cached_property
    def sub(self) -> DataFrame:
        return self.fx["sub"]

    @cached_property
    def lines(self) -> DataFrame:
        """The records as text lines, with their id."""
        fields = {f.name for f in layout.LAYOUT}
        values = {c: F.col(c) for c in self.sub.columns if c in fields}
        return self.sub.select("input_order", layout.build(values).alias("value"))

    @cached_property
    def feed(self) -> DataFrame:
        """Lines with end marks and empty lines among them."""
        mark = F.col("input_order") % 1000
        value = F.when(mark == 7, "").when(mark == 8, "E").otherwise(F.col("value"))
        return self.lines.withColumn("value", value)

    @cached_property
    def lazy_records(self) -> DataFrame:
        return cl.classify(intake.validate(self.sub, self.cfg), self.cfg)

    @cached_property
    def records(self) -> DataFrame:
        """The classified records with the fields a run keeps of them; cutting out the others costs more than all matching."""
        kept = [self.cfg.record_id, self.cfg.special_id, *intake.MATCH_COLUMNS, "cls"]
        return stage(self.lazy_records.select(*kept), "records")

    @cached_property
    def regular(self) -> DataFrame:
        return self.records.filter(F.col("cls") == cl.REGULAR)

    @cached_property
    def pseudo(self) -> DataFrame:
        return self.records.filter(F.col("cls") == cl.PSEUDO)

    @cached_property
    def lazy_regular(self) -> DataFrame:
        return self.lazy_records.filter(F.col("cls") == cl.REGULAR)

    @cached_property
    def masters(self) -> en.Masters:
        """The masters as stored tables: matching, change-sets and merges read them, none derives them again."""
        fx = fixtures.stored_masters(self.fx)
        return en.Masters(
            names=fx["m_name"],
            addresses=fx["m_address"],
            special=fx["m_special"],
            links=fx["m_link"],
            link_sources=fx["m_link_source"],
            link_types=fx["m_link_type"],
        )

    @cached_property
    def exact(self) -> DataFrame:
        inputs = names.name_inputs(self.lazy_regular, self.cfg)
        return stage(names.exact_names(inputs, self.fx["fx_name"]), "exact")

    @cached_property
    def scored(self) -> DataFrame:
        unmatched = self.exact.filter(F.col("name_ind") == "N")
        return names.fuzzy_names(unmatched, self.fx["fx_name"], self.cfg)

    @cached_property
    def primary(self) -> DataFrame:
        inputs = ad.address_inputs(self.regular, self.cfg)
        lookup = ad.address_lookup(self.fx["fx_addr"])
        matched = stage(ad.match_addresses(inputs, lookup), "matched")
        return stage(ad.resolve_primary(matched, self.fx["fx_addr"], self.cfg), "primary")

    @cached_property
    def opt_matched(self) -> DataFrame:
        inputs = ad.address_inputs(self.regular, self.cfg, optional=True)
        return ad.match_addresses(inputs, ad.address_lookup(self.fx["fx_addr"]))

    @cached_property
    def optional(self) -> DataFrame:
        shared = stage(ad.share_primary(self.opt_matched, self.primary), "shared")
        return ad.resolve_optional(shared, self.primary, self.fx["fx_addr"], self.cfg)

    @cached_property
    def special(self) -> DataFrame:
        return special.special_table(self.pseudo, self.fx["fx_special"], self.cfg)

    @cached_property
    def outcome(self) -> DataFrame:
        records, masters = together(self.spark, lambda: self.records, lambda: self.masters)
        return en.resolve(records, masters, self.cfg)

    @cached_property
    def matched(self) -> tuple[DataFrame, DataFrame]:
        """Records and their outcome; the outcome is asked first, so that the records are stored beside the masters."""
        outcome = self.outcome
        return self.records, outcome

    @cached_property
    def deciding(self) -> DataFrame:
        """The deciding rows, for what reads them once: of their columns only those that are asked for are joined."""
        return en.deciding_table(*self.matched, self.cfg)

    @cached_property
    def main(self) -> DataFrame:
        return stage(self.deciding, "main")

    @cached_property
    def pairs(self) -> DataFrame:
        return en.link_pairs(self.deciding, self.cfg)


# --- sources, sinks, stages


def src_text(c: Case) -> DataFrame:
    path = c.scratch("lines")
    # The lines are mostly blanks: compressed, a small part of their bytes goes to disk.
    c.lines.select("value").write.option("compression", "gzip").text(path)
    return intake.read_lines(c.spark, path).select("value")


def parse_fixed_width(c: Case) -> DataFrame:
    return layout.parse(c.lines).drop("value")


def valid_split(c: Case) -> DataFrame:
    valid, _ = intake.split_valid(c.feed)
    return valid


def rejects(c: Case) -> DataFrame:
    _, bad = intake.split_valid(c.feed)
    path = c.scratch("rejects")
    intake.write_rejects(bad, path)
    return c.spark.read.option("header", True).schema(bad.schema).csv(path).fillna({"value": ""})


def src_partitioned(c: Case) -> DataFrame:
    tests = tables.slice_predicates("empr_id", 8)
    hits = sum((F.expr(t).cast("int") for t in tests), F.lit(0))
    return c.fx["fx_addr"].select("empr_id", "addr_snum", hits.alias("slices"))


def key_filter_semi(c: Case) -> DataFrame:
    ids = keyed.distinct_keys(c.lazy_regular.select(F.col("work_ein").alias("empr_id")), "empr_id")
    return keyed.restrict(c.fx["fx_name"], ids, ["empr_id"])


def stage_roundtrip(c: Case) -> DataFrame:
    return stage(c.lazy_records, "roundtrip").select(
        "input_order", "cls", "work_ein", "qw_employer_name", "addr1", "empr_forgn_zip"
    )


def patch_fixed_width(c: Case) -> DataFrame:
    done = c.outcome.select("input_order", *asm.INDICATORS, *asm.POINTERS)
    wide = asm.payload_rejoin(done, c.lines, "input_order")
    return layout.patch(wide, layout.result_span()).select("input_order", "value")


def payload_rejoin(c: Case) -> DataFrame:
    narrow = c.lazy_records.select("input_order", "cls")
    return asm.payload_rejoin(narrow, c.lines, "input_order")


def run_label(c: Case) -> DataFrame:
    r = F.col("o_orderkey")
    day = F.concat(F.lit(".R"), F.lpad((r % 1000000).cast("string"), 6, "0"))
    time = F.concat(F.lit(".T"), F.lpad((r % 240000).cast("string"), 6, "0"))
    name = F.concat(
        F.lit("IN"),
        F.when(r % 3 == 0, F.concat(day, time, F.lit(".txt")))
        .when(r % 3 == 1, F.concat(day, F.lit(".txt")))
        .otherwise(F.concat(F.lit(".DATA"), r.cast("string"))),
    )
    return c.fx["orders"].select(
        "o_orderkey", publish.run_label(name, c.cfg.run_ts).alias("label")
    )


# --- projections and predicates


def mask_invalid(c: Case) -> DataFrame:
    return intake.mask_invalid(c.sub).select("input_order", "wrk_ssn", "final_ssn")


def validate_id(c: Case) -> DataFrame:
    return intake.validate_id(c.sub, c.cfg).select(
        "input_order", "vald_ein_cd", "final_empr_nm", "wrk_empr_nm"
    )


def flag_guard(c: Case) -> DataFrame:
    cols = [x for _, field, derived in intake.FLAG_GUARDS for x in (field, derived)]
    return intake.flag_guard(c.sub).select("input_order", *cols)


def alias_project(c: Case) -> DataFrame:
    return intake.alias_project(c.sub).select("input_order", *intake.ALIASES)


def normalize(c: Case) -> DataFrame:
    return c.sub.select(
        "input_order",
        norm(F.col("qw_employer_name")).alias("nm"),
        key(F.col("qw_empr_address1")).alias("addr1"),
        key(F.col("qw_empr_city")).alias("city"),
        key(F.col("qw_empr_opt_address1")).alias("opt_addr1"),
    )


def classify(c: Case) -> DataFrame:
    return c.lazy_records.select("input_order", "cls")


def unknown_out(c: Case) -> DataFrame:
    return cl.unknown_outcome(c.lazy_records, c.cfg)


def addr_quality_code(c: Case) -> DataFrame:
    return c.sub.select("input_order", quality_code(F.col("fnl_empr_err_tab")).alias("addrck_pmycd"))


def scalar_functions(c: Case) -> DataFrame:
    name, rec = F.col("qw_employer_name"), F.col("file_rec_num_id")
    return c.sub.select(
        "input_order",
        F.substring(name, 3, 7).alias("f_substring"),
        F.substring(name, 60, 7).alias("f_past_end"),
        F.trim(name).alias("f_trim"),
        F.upper(name).alias("f_upper"),
        F.length(name).alias("f_length"),
        F.lpad("empr_ein", 9, "0").alias("f_lpad"),
        F.rpad("empr_ein", 7, " ").alias("f_rpad"),
        F.concat("work_ein", F.lit("-"), name).alias("f_concat"),
        F.col("empr_ein").rlike("^[0-9]{9}$").alias("f_rlike"),
        F.col("batch_number").isin("999999", "000002").alias("f_isin"),
        F.when(F.col("ssn_val_code") == "I", "bad").otherwise("good").alias("f_when"),
        F.coalesce(F.when(F.length(name) > 0, name), F.lit("none")).alias("f_coalesce"),
        F.least(F.length(name), F.length("empr_ein")).alias("f_least"),
        F.greatest(F.length(name), F.length("empr_ein")).alias("f_greatest"),
        F.when(F.length(name) > 0, name).isNull().alias("f_is_null"),
        F.to_date(F.lit("2024-06-30"), "yyyy-MM-dd").alias("f_date"),
        F.trim(rec).try_cast("int").alias("f_int"),
        F.col("input_order").cast("string").alias("f_string"),
        (F.col("input_order") * 2 + 1).alias("f_arithmetic"),
        (~(F.col("batch_number") == "999999") & (F.length(name) > 4)).alias("f_logic"),
        F.regexp_extract(name, "([0-9]+)", 1).alias("f_regexp"),
    )


# --- keys and aggregates


def distinct_keys(c: Case) -> DataFrame:
    def keys(df: DataFrame, column: str, label: str) -> DataFrame:
        return keyed.distinct_keys(df.select(F.lit(label).alias("key_set"), F.col(column).alias("id")), "key_set", "id")

    rec = c.lazy_records
    return (
        keys(rec, "work_ein", "run")
        .unionByName(keys(rec, "empr_ein", "special_column"))
        .unionByName(keys(c.lazy_regular, "work_ein", "regular"))
        .unionByName(keys(rec.filter(F.col("cls") == cl.PSEUDO), "work_ein", "pseudo"))
        .unionByName(keys(c.fx["fx_name"], "empr_id", "master"))
    )


def max_seq(c: Case) -> DataFrame:
    def last(table: str, on: str, seq: str) -> DataFrame:
        return keyed.max_seq(c.fx[table], [on], seq, "last").select(
            F.lit(table).alias("table_name"), F.col(on).alias("id"), "last"
        )

    return (
        last("fx_name", "empr_id", "nm_snum")
        .unionByName(last("fx_addr", "empr_id", "addr_snum"))
        .unionByName(last("fx_special", "empr_idfr", "empr_snum"))
    )


def dedup_first(c: Case) -> DataFrame:
    rows = special.special_keys(c.lazy_records.filter(F.col("cls") == cl.PSEUDO), c.cfg)
    first = keyed.keep_first(rows, special.ON, [F.col("input_order")])
    return first.select("input_order", "empr_idfr", "qw_employer_name", "addr1")


def run_summary(c: Case) -> DataFrame:
    taken = intake.take_in(c.feed.withColumn("source_file", F.lit("IN.txt")), c.cfg)
    return asm.run_summary(cl.classify(taken.records, c.cfg), taken.lines, taken.rejected)


def conservation_check(c: Case) -> DataFrame:
    return asm.check_conserved(*c.matched, "input_order")


def align_union(c: Case) -> DataFrame:
    rec = c.lazy_records
    unknown = cl.unknown_outcome(rec, c.cfg)
    pseudo = rec.filter(F.col("cls") == cl.PSEUDO).select(
        "input_order", "cls", F.lit("O").alias("empr_table_ind"), "empr_addr_inp_ind_cd"
    )
    regular = rec.filter(F.col("cls") == cl.REGULAR).select("input_order", "cls", "qw_empr_forgn_cc")
    return asm.align_union([unknown, pseudo, regular], asm.role_defaults())


# --- names


def exact_name(c: Case) -> DataFrame:
    inputs = names.name_inputs(c.lazy_regular, c.cfg)
    return names.exact_names(inputs, c.fx["fx_name"]).select("empr_id", "nm", "nm_snum", "name_ind")


def fuzzy_candidates(c: Case) -> DataFrame:
    return c.scored.withColumn("score", F.round("score", 6))


def best_fuzzy(c: Case) -> DataFrame:
    return names.best_fuzzy(c.scored).withColumn("score", F.round("score", 6))


def new_name_seq(c: Case) -> DataFrame:
    resolved = stage(names.resolve_names(c.exact, c.scored), "resolved")
    numbered = names.number_names(resolved, c.fx["fx_name"], c.cfg)
    return numbered.filter(F.col("name_ind") == "N").select("empr_id", "nm", "nm_snum")


def name_resolution(c: Case) -> DataFrame:
    resolved = stage(names.resolve_names(c.exact, c.scored), "resolved")
    numbered = stage(names.number_names(resolved, c.fx["fx_name"], c.cfg), "numbered")
    rows = c.lazy_regular.select(
        "input_order", F.col("work_ein").alias("empr_id"), norm(F.col("qw_employer_name")).alias("nm")
    )
    done = keyed.attach(rows, numbered.drop("first_id"), names.ON, "n", ["input_order"])
    return done.select(
        "input_order",
        F.coalesce("nm_snum", F.lit(0)).alias("empr_name_pntr"),
        F.coalesce("name_ind", F.lit(" ")).alias("empr_name_ind"),
    )


def backfill_names(c: Case) -> DataFrame:
    filled = c.outcome.filter(F.col("empr_name_ind") == "R")
    return filled.select("input_order", "empr_addr_pntr", "empr_name_pntr", "filled_name")


# --- addresses


def addr_dedup_latest(c: Case) -> DataFrame:
    return ad.address_lookup(c.fx["fx_addr"])


def addr_match(c: Case) -> DataFrame:
    inputs = ad.address_inputs(c.lazy_regular, c.cfg)
    return ad.match_addresses(inputs, ad.address_lookup(c.fx["fx_addr"]))


def new_addr_seq(c: Case) -> DataFrame:
    return ad.new_primary(c.primary)


def addr_resolution(c: Case) -> DataFrame:
    return c.outcome.filter(F.col("cls") == cl.REGULAR).select(
        "input_order", "empr_addr_pntr", "empr_addr_ind", "empr_addr_inp_ind_cd"
    )


def opt_addr_match(c: Case) -> DataFrame:
    inputs = ad.address_inputs(c.lazy_regular, c.cfg, optional=True)
    return ad.match_addresses(inputs, ad.address_lookup(c.fx["fx_addr"]))


def new_opt_addr(c: Case) -> DataFrame:
    return ad.new_optional(c.opt_matched, c.primary).select(*ad.ON)


def new_opt_seq(c: Case) -> DataFrame:
    return c.optional.filter(F.col("origin") == "new").select(*ad.ON, "addr_snum")


def opt_resolution(c: Case) -> DataFrame:
    return c.outcome.filter(F.col("cls") == cl.REGULAR).select(
        "input_order", "empr_opt_addr_pntr", "empr_opt_addr_ind"
    )


def table_indicator(c: Case) -> DataFrame:
    ids = keyed.distinct_keys(c.lazy_regular.select(F.col("work_ein").alias("empr_id")), "empr_id")
    pseudo = c.lazy_records.filter(F.col("cls") == cl.PSEUDO)
    return ad.table_indicators(ids, c.fx["fx_name"], pseudo.select(F.col("work_ein").alias("empr_id")))


# --- special ids and outcomes


def special_seq(c: Case) -> DataFrame:
    return c.special.drop("n")


def special_resolution(c: Case) -> DataFrame:
    return en.special_outcome(c.records, c.special, c.cfg).drop("cls", "master_id")


def indicators(c: Case) -> DataFrame:
    return c.outcome.select("input_order", *asm.INDICATORS, *asm.POINTERS)


def main_tmp(c: Case) -> DataFrame:
    return en.main_table(*c.matched, c.cfg).select("input_order", *asm.MAIN_COLUMNS)


def enriched_output(c: Case) -> DataFrame:
    records = stage(intake.matchable(c.lines, c.cfg), "records")
    return en.enriched(records, en.match(records, c.masters, c.cfg), c.cfg)


# --- change-sets and merge


def _told(df: DataFrame) -> DataFrame:
    """Times as text: the run's by its own name, stored ones as they read in the session's time zone."""
    run = F.lit(str(CFG.run_ts))
    return df.withColumns({t: F.when(F.col(t) == F.lit(CFG.run_ts), run).otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss")) for t in TIMES})


def _set(c: Case, src: DataFrame, spec: cs.TableSpec, no_update: str | None = None) -> DataFrame:
    master = c.masters.tables()[spec.name]
    return _told(cs.change_set(src, master, spec, c.cfg, no_update))


def cs_special(c: Case) -> DataFrame:
    return _set(c, cs.special_rows(c.deciding, c.cfg), cs.SPECIAL)


def cs_name(c: Case) -> DataFrame:
    return _set(c, cs.name_rows(c.deciding, c.cfg), cs.NAME)


def cs_addr(c: Case) -> DataFrame:
    return _set(c, cs.address_rows(c.deciding, c.cfg), cs.ADDRESS)


def cs_opt_addr(c: Case) -> DataFrame:
    rows = cs.optional_address_rows(c.deciding, c.cfg).withColumn("_optional", F.lit(True))
    return _set(c, rows, cs.ADDRESS, no_update="_optional")


def cs_link(c: Case) -> DataFrame:
    return _set(c, c.pairs, cs.LINK)


def cs_link_source(c: Case) -> DataFrame:
    return _set(c, cs.link_source_rows(c.pairs), cs.LINK_SOURCE)


def cs_link_type(c: Case) -> DataFrame:
    return _set(c, cs.link_type_rows(c.pairs), cs.LINK_TYPE)


def merge_update(c: Case) -> DataFrame:
    return _told(merge.merge_update(c.masters.names, cs_name(c), cs.NAME, c.cfg))


def merge_insert(c: Case) -> DataFrame:
    changes = cs.address_changes(c.main, c.masters.addresses, c.cfg)
    return _told(merge.merge_insert(c.masters.addresses, changes, cs.ADDRESS))


def _merged(spec: cs.TableSpec) -> Callable[[Case], DataFrame]:
    """A master after the whole run's changes."""

    def build(c: Case) -> DataFrame:
        changes = en.change_sets(c.main, c.masters, c.cfg)[spec.name]
        return _told(merge.merge(c.masters.tables()[spec.name], stage(changes, spec.name), spec, c.cfg))

    return build


# --- masters in buckets


def _publish_names(c: Case, names: DataFrame) -> tuple[str, dict[str, dict]]:
    """A root whose only run published these names, and how they are laid out."""
    root = c.scratch("root")
    paths = publish.write_buckets(names, f"{root}/snapshots/first", "name", "empr_id", c.cfg.master_buckets)
    layout = {"buckets": c.cfg.master_buckets, "schemas": {"name": json.dumps(names.schema.jsonValue())}}
    publish.publish(c.spark, root, "first", "first", c.cfg.run_ts, paths, 0, layout)
    return root, layout


def _part(c: Case, root: str, like: DataFrame, touched: list[int]) -> DataFrame:
    own = publish.bucket_paths(publish.current(c.spark, root), "name")
    return publish.read_paths(c.spark, like.schema, [own[n] for n in touched if n in own])


def key_filter_buckets(c: Case) -> DataFrame:
    """``key_filter_semi`` on published masters: buckets without an id of the run are not read."""
    known = c.fx["fx_name"]
    root, _ = _publish_names(c, known)
    ids = keyed.distinct_keys(c.lazy_regular.select(F.col("work_ein").alias("empr_id")), "empr_id")
    touched = publish.buckets_in(ids, F.col("empr_id"), c.cfg.master_buckets)
    return keyed.restrict(_part(c, root, known, touched), ids, ["empr_id"])


def merge_by_bucket(c: Case) -> DataFrame:
    """``merge_name`` on published masters: only buckets with changes are read and written, all are published together."""
    known = cs.NAME.of(c.masters.names)
    root, layout = _publish_names(c, known)
    changes = stage(en.change_sets(c.main, c.masters, c.cfg)["name"], "changes")
    touched = publish.buckets_in(changes, F.col("empr_id"), c.cfg.master_buckets)
    merged = merge.merge(_part(c, root, known, touched), changes, cs.NAME, c.cfg)
    new = publish.write_buckets(merged, f"{root}/snapshots/second", "name", "empr_id", c.cfg.master_buckets)
    paths = {**publish.current(c.spark, root).paths, **new}
    publish.publish(c.spark, root, "second", "second", c.cfg.run_ts, paths, 1, layout)
    return _told(publish.read_current(c.spark, root, "name"))


def numbers_in_use(c: Case) -> DataFrame:
    """Highest numbers per id as a run keeps them: raised by its change-sets, in the buckets these touch."""
    root, changes, parts = c.scratch("numbers"), en.change_sets(c.main, c.masters, c.cfg), []
    for spec in en.NUMBERED:
        (on, seq), name = spec.key, en.IN_USE[spec.name]
        kept = numbering.last_numbers(None, c.masters.tables()[spec.name], [on], seq)
        paths = publish.write_buckets(kept, f"{root}/first", name, on, c.cfg.master_buckets)
        given = stage(changes[spec.name].select(*spec.key), name)
        touched = publish.buckets_in(given, F.col(on), c.cfg.master_buckets)
        own = publish.read_paths(c.spark, kept.schema, [p for n in touched if (p := paths.get(f"{name}/{n}"))])
        paths |= publish.write_buckets(numbering.raised(own, given, [on], seq), f"{root}/second", name, on, c.cfg.master_buckets)
        last = publish.read_paths(c.spark, kept.schema, list(paths.values()))
        parts.append(last.select(F.lit(spec.name).alias("table_name"), F.col(on).alias("id"), "last"))
    return reduce(DataFrame.unionByName, parts)


_PLAIN = [
    src_text, parse_fixed_width, valid_split, rejects, src_partitioned, key_filter_semi,
    stage_roundtrip, patch_fixed_width, payload_rejoin, run_label, mask_invalid, validate_id,
    flag_guard, alias_project, normalize, classify, unknown_out, addr_quality_code,
    scalar_functions, distinct_keys, max_seq, dedup_first, run_summary,
    conservation_check, align_union, exact_name, fuzzy_candidates, best_fuzzy, new_name_seq,
    name_resolution, backfill_names, addr_dedup_latest, addr_match, new_addr_seq,
    addr_resolution, opt_addr_match, new_opt_addr, new_opt_seq, opt_resolution,
    table_indicator, special_seq, special_resolution, indicators, main_tmp, enriched_output,
    cs_name, cs_addr, cs_opt_addr, cs_link, cs_link_source, cs_link_type, merge_update,
    merge_insert, key_filter_buckets, merge_by_bucket,
]

REUSING = replace(CFG, reuse_special=True)

QUERIES: dict[str, tuple[Callable[[Case], DataFrame], MatchConfig]] = {
    **{f.__name__: (f, CFG) for f in _PLAIN},
    # Only reused numbers can meet an existing row, so these run with reuse on.
    "cs_special": (cs_special, REUSING),
    "numbers_in_use": (numbers_in_use, REUSING),
    **{f"merge_{t.name}": (_merged(t), REUSING if t is cs.SPECIAL else CFG) for t in cs.TABLES},
}


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build, cfg = QUERIES[name]
    return lambda spark, sf_dir: build(Case(spark, sf_dir, cfg))
