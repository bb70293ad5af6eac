"""The whole flow: records in, outcome per record, change-sets, new masters."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlink.config import MatchConfig
from ledgerlink.functions.normalize import first_match, key, norm
from ledgerlink.operators import addresses, assemble, changeset, merge, names, special
from ledgerlink.operators.backfill import linked_names
from ledgerlink.operators.classify import PSEUDO, REGULAR, classify, unknown_outcome
from ledgerlink.operators.keyed import attach, distinct_keys, keep_first, lookup_side, restrict, small
from ledgerlink.operators.numbering import last_numbers, raised
from ledgerlink.sources import intake, publish
from ledgerlink.staging import file_marks, part_of_job, stage, stages_of, together

REJECTS_CSV = "rejects_csv"


# The field of ``Masters`` that holds each table.
FIELD_OF = {
    changeset.NAME.name: "names",
    changeset.ADDRESS.name: "addresses",
    changeset.SPECIAL.name: "special",
    changeset.LINK.name: "links",
    changeset.LINK_SOURCE.name: "link_sources",
    changeset.LINK_TYPE.name: "link_types",
}
# The tables that number their rows within an id (by the second column of their key), and what keeps their highest numbers.
NUMBERED = (changeset.SPECIAL, changeset.NAME, changeset.ADDRESS)
IN_USE = {spec.name: f"{spec.name}_in_use" for spec in NUMBERED}


@dataclass(frozen=True)
class Masters:
    """The six master tables, addresses under their stored column names.

    ``in_use`` holds, by table, the highest number each id was ever given; a table that is not there is asked itself.
    """

    names: DataFrame
    addresses: DataFrame
    special: DataFrame
    links: DataFrame
    link_sources: DataFrame
    link_types: DataFrame
    in_use: Mapping[str, DataFrame] = field(default_factory=dict, kw_only=True)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, field) for name, field in FIELD_OF.items()}

    def limited(self, records: DataFrame, cfg: MatchConfig) -> Masters:
        """What may hold the ids of some records; everything where no layout is known."""
        return self


@dataclass(frozen=True)
class PublishedMasters(Masters):
    """Masters as a run published them, in buckets of their id, and the number of that run."""

    spark: SparkSession
    version: int
    buckets: int
    schemas: dict[str, StructType]
    paths: dict[str, dict[int, str]]

    def part(self, name: str, numbers: Iterable[int]) -> DataFrame:
        """The rows of some buckets; the files of the others are not read, nor listed."""
        own = self.paths[name]
        return publish.read_paths(self.spark, self.schemas[name], [own[n] for n in numbers if n in own])

    def limited(self, records: DataFrame, cfg: MatchConfig) -> Masters:
        regular = publish.buckets_in(records, F.col(cfg.entity_id), self.buckets)
        special_ids = publish.buckets_in(records, F.coalesce(cfg.special_id, F.lit("")), self.buckets)
        numbers = {name: special_ids if name == changeset.SPECIAL.name else regular for name in FIELD_OF}
        in_use = {name: self.part(IN_USE[name], numbers[name]) for name in self.in_use}
        return Masters(**{f: self.part(name, numbers[name]) for name, f in FIELD_OF.items()}, in_use=in_use)


def read_masters(spark: SparkSession, root: str) -> PublishedMasters:
    """The masters of the run published last; a run that uses them publishes only if none came between."""
    row = publish.current(spark, root)
    schemas = {name: StructType.fromJson(json.loads(text)) for name, text in row.schemas.items()}
    paths = {name: publish.bucket_paths(row, name) for name in schemas}
    whole = {name: publish.read_paths(spark, schemas[name], list(paths[name].values())) for name in schemas}
    tables = {f: whole[name] for name, f in FIELD_OF.items()}
    in_use = {name: whole[kept] for name, kept in IN_USE.items() if kept in whole}
    layout = {"version": row.seq, "buckets": row.buckets, "schemas": schemas, "paths": paths}
    return PublishedMasters(**tables, in_use=in_use, spark=spark, **layout)


def write_masters(
    masters: Masters, limited: Masters, changes: dict[str, DataFrame], folder: str, cfg: MatchConfig
) -> tuple[dict[str, str], dict[str, object]]:
    """Manifest paths of the six masters with their changes, and how they are laid out.

    Of published masters only the buckets that have changes are read and written; the others stay where they are.
    """
    kept = isinstance(masters, PublishedMasters)
    buckets = masters.buckets if kept else cfg.master_buckets
    paths, schemas = {}, {}
    for spec in changeset.TABLES:
        name, key, old = spec.name, spec.key[0], limited.tables()[spec.name]
        if kept:
            touched = publish.buckets_in(changes[name], F.col(key), buckets)
            paths |= {f"{name}/{n}": p for n, p in masters.paths[name].items()}
            old = masters.part(name, touched)
        merged = merge.merge(old, changes[name], spec, cfg)
        schemas[name] = json.dumps(merged.schema.jsonValue())
        if not kept or touched:
            paths |= publish.write_buckets(merged, folder, name, key, buckets)
        if spec not in NUMBERED:
            continue
        in_use, seq, known = IN_USE[name], spec.key[1], masters.in_use.get(name)
        if kept and known is not None:
            paths |= {f"{in_use}/{n}": p for n, p in masters.paths[in_use].items()}
            last = masters.part(in_use, touched)
        else:  # plain frames, or published before their numbers were kept: all rows are asked, this once
            last = last_numbers(known, masters.tables()[name], [key], seq)
        last = raised(last, changes[name], [key], seq)
        schemas[in_use] = json.dumps(last.schema.jsonValue())
        if not kept or known is None or touched:
            paths |= publish.write_buckets(last, folder, in_use, key, buckets)
    return paths, {"buckets": buckets, "schemas": schemas}


def regular_outcome(
    records: DataFrame,
    name_tab: DataFrame,
    primary_tab: DataFrame,
    optional_tab: DataFrame,
    cfg: MatchConfig,
) -> DataFrame:
    """Three lookups bring every regular record its numbers; the rest is decided per row.

    The lookups hold one row per distinct name or address, so records repeat freely.
    """
    rid, place = cfg.record_id, addresses.PLACE
    nm, opt = norm(F.col("qw_employer_name")), key(F.col("opt_addr1"))
    opt_cols = [f"opt_{c}" for c in place]
    # What is asked of a text after its lookup is kept as a flag, so that the text itself is not sent on.
    rows = records.filter(F.col("cls") == REGULAR).select(
        rid,
        F.col(cfg.entity_id).alias("empr_id"),
        assemble.padded_id().alias("master_id"),
        F.when(F.length(nm) > 0, nm).alias("nm"),
        *[key(F.col(c)).alias(c) for c in place],
        *[F.when(opt != "", key(F.col(c))).alias(c) for c in opt_cols],
        F.coalesce(F.length(nm) > 0, F.lit(False)).alias("named"),
        (opt != "").alias("has_opt"),
        (F.col("vald_ein_cd") == "I").alias("invalid"),
    )
    primary_tab = primary_tab.withColumnsRenamed({"origin": "addr_origin", "first_id": "addr_first"})
    optional_tab = optional_tab.withColumnsRenamed(
        {
            **dict(zip(place, opt_cols)),
            "addr_snum": "opt_snum",
            "origin": "opt_origin",
            "first_id": "opt_first",
        }
    )
    # The widest key first, the lookup that gives texts (linked names) last: rows get narrower from one to the next.
    # Records without an optional address have nothing to look up there and are not sent.
    told = attach(rows.filter("has_opt"), optional_tab, ["empr_id", *opt_cols], "n", [rid], cfg.limits)
    rows = told.unionByName(rows.filter(~F.col("has_opt")), allowMissingColumns=True).drop(*opt_cols)
    rows = attach(rows, name_tab.drop("first_id"), names.ON, "n", [rid], cfg.limits).drop("nm")
    rows = attach(rows, primary_tab, addresses.ON, "n", [rid], cfg.limits)

    col, lit = F.col, F.lit
    filled = ~col("named") & (col("addr_snum") > 0) & col("link_nm").isNotNull()
    matched = col("addr_origin") == "known"
    return rows.select(
        rid,
        lit(REGULAR).alias("cls"),
        "master_id",
        F.when(filled, col("link_nm_snum")).otherwise(F.coalesce("nm_snum", lit(0))).alias("empr_name_pntr"),
        F.coalesce("addr_snum", lit(0)).alias("empr_addr_pntr"),
        F.coalesce("opt_snum", lit(0)).alias("empr_opt_addr_pntr"),
        F.coalesce("table_ind", lit(" ")).alias("empr_table_ind"),
        F.when(filled, lit("R")).otherwise(F.coalesce("name_ind", lit(" "))).alias("empr_name_ind"),
        first_match(
            [
                (col("invalid"), lit("X")),
                (matched, lit("F")),
                (col(rid) == col("addr_first"), lit("N")),
            ],
            lit("F"),
        ).alias("empr_addr_ind"),
        first_match(
            [
                (~col("has_opt"), lit(" ")),
                (col("opt_origin") == "known", lit("F")),
                (col(rid) == col("opt_first"), lit("N")),
            ],
            lit("F"),
        ).alias("empr_opt_addr_ind"),
        F.when(matched, lit("F")).otherwise(lit("N")).alias("empr_addr_inp_ind_cd"),
        F.when(filled, col("link_nm")).alias("filled_name"),
    )


def special_outcome(records: DataFrame, special_tab: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Special-id records: every duplicate gets the number of its entity."""
    rows = special.special_keys(records.filter(F.col("cls") == PSEUDO), cfg)
    rows = rows.select(
        cfg.record_id, "cls", *special.ON, "vald_ein_cd", "empr_addr_inp_ind_cd"
    )
    table = special_tab.drop("first_id")
    return attach(rows, table, special.ON, "n", [cfg.record_id], cfg.limits).select(
        cfg.record_id,
        "cls",
        F.col("empr_idfr").alias("master_id"),
        F.coalesce("empr_snum", F.lit(0)).alias("empr_addr_pntr"),
        F.lit("O").alias("empr_table_ind"),
        F.when(F.col("vald_ein_cd") == "I", "X").otherwise("N").alias("empr_addr_ind"),
        "empr_addr_inp_ind_cd",
    )


def resolve(
    records: DataFrame, masters: Masters, cfg: MatchConfig
) -> DataFrame:
    """Outcome of every classified record (staged, one narrow row each)."""
    regular = records.filter(F.col("cls") == REGULAR)
    pseudo = records.filter(F.col("cls") == PSEUDO)
    ids = distinct_keys(regular.select(F.col(cfg.entity_id).alias("empr_id")), "empr_id")
    special_ids = distinct_keys(
        pseudo.select(F.coalesce(cfg.special_id, F.lit("")).alias("empr_idfr")), "empr_idfr"
    )
    ids, special_ids = lookup_side(stage(ids, "ids"), cfg.limits), lookup_side(stage(special_ids, "special_ids"), cfg.limits)
    known_addr = restrict(changeset.address_view(masters.addresses), ids, ["empr_id"])
    spark = records.sparkSession
    known_names, known_addr = together(
        spark,
        lambda: stage(restrict(masters.names, ids, ["empr_id"]), "master_names"),
        lambda: stage(known_addr.select(*addresses.ON, "addr_snum"), "master_addresses"),
    )
    links = restrict(masters.links, ids, ["empr_id"])
    known_special = restrict(masters.special, special_ids, ["empr_idfr"])
    in_use = masters.in_use
    last_name, last_addr, last_special = (in_use.get(s.name) for s in (changeset.NAME, changeset.ADDRESS, changeset.SPECIAL))

    def address_tables() -> tuple[DataFrame, DataFrame]:
        primary = addresses.primary_table(
            regular,
            known_addr,
            known_names,
            pseudo.select(F.col(cfg.entity_id).alias("empr_id")),
            linked_names(links, known_names),
            cfg,
            last_addr,
        )
        return primary, addresses.optional_table(regular, primary, known_addr, cfg, last_addr)

    name_tab, (primary_tab, optional_tab), special_tab = together(
        spark,
        lambda: names.name_table(regular, known_names, cfg, last_name),
        address_tables,
        lambda: special.special_table(pseudo, known_special, cfg, last_special),
    )

    outcome = assemble.align_union(
        [
            unknown_outcome(records, cfg),
            special_outcome(records, special_tab, cfg),
            regular_outcome(records, name_tab, primary_tab, optional_tab, cfg),
        ],
        assemble.role_defaults(),
    )
    return stage(outcome, "outcome")


def match(
    records: DataFrame, masters: Masters, cfg: MatchConfig
) -> DataFrame:
    """The outcome of staged records, checked to be theirs one to one."""
    outcome = resolve(classify(records, cfg), masters, cfg)
    assemble.require_conserved(records, outcome, cfg.record_id)
    return outcome


def enriched(records: DataFrame, outcome: DataFrame, cfg: MatchConfig) -> DataFrame:
    """The enriched file. Lines meet their outcome whole and are cut up afterwards."""
    lines = records.select(cfg.record_id, "value")
    joined = assemble.join_outcome(lines, outcome, cfg.record_id)
    return assemble.enriched_output(assemble.take_outcome(intake.fields(joined, cfg)))


def main_table(records: DataFrame, outcome: DataFrame, cfg: MatchConfig) -> DataFrame:
    """The main temp table with what the change-sets need beside it."""
    return _main_rows(assemble.join_outcome(records.drop("value"), outcome, cfg.record_id), cfg)


def _main_rows(joined: DataFrame, cfg: MatchConfig) -> DataFrame:
    extra = [cfg.record_id, "cls", cfg.special_id, *assemble.CHANGE_COLUMNS]
    return assemble.main_tmp(assemble.take_outcome(joined), extra)


def deciding_table(records: DataFrame, outcome: DataFrame, cfg: MatchConfig) -> DataFrame:
    """``main_table`` of only the records that decide the change-sets: one for each number and link at most.

    All records meet their ids in two joins by record id that sort neither records nor outcomes; what is left is as large as
    the numbered entities, however many records repeat them.
    """
    rid = cfg.record_id
    firsts = stage(changeset.deciding_records(outcome, cfg), "deciding")
    if small(firsts, cfg.limits):
        told = stage(outcome.join(F.broadcast(firsts), rid, "left_semi"), "deciding_outcome")
        told = lookup_side(told, cfg.limits)
    else:  # both joins find the outcomes where the first one has put them
        told = outcome.join(firsts.hint("shuffle_hash"), rid, "left_semi").hint("shuffle_hash")
    return _main_rows(records.drop("value").join(assemble.packed_outcome(told, rid), rid), cfg)


def link_pairs(main: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Pairs of name and address, which three tables hold: found once for all of them."""
    pairs = keep_first(
        changeset.link_rows(main, cfg), changeset.LINK.key, [F.col(cfg.record_id)]
    )
    return stage(pairs, "link_pairs")


def change_sets(
    main: DataFrame, masters: Masters, cfg: MatchConfig
) -> dict[str, DataFrame]:
    """One change-set per master table, from the main temp table (staged), or its deciding rows."""
    cs, pairs = changeset, link_pairs(main, cfg)
    return {
        cs.SPECIAL.name: cs.change_set(cs.special_rows(main, cfg), masters.special, cs.SPECIAL, cfg),
        cs.NAME.name: cs.change_set(cs.name_rows(main, cfg), masters.names, cs.NAME, cfg),
        cs.ADDRESS.name: cs.address_changes(main, masters.addresses, cfg),
        cs.LINK.name: cs.change_set(pairs, masters.links, cs.LINK, cfg),
        cs.LINK_SOURCE.name: cs.change_set(
            cs.link_source_rows(pairs), masters.link_sources, cs.LINK_SOURCE, cfg
        ),
        cs.LINK_TYPE.name: cs.change_set(
            cs.link_type_rows(pairs), masters.link_types, cs.LINK_TYPE, cfg
        ),
    }


@dataclass(frozen=True)
class RunResult:
    """What a run published: frames that read it, and its counts."""

    label: str
    attempt: str
    output: DataFrame
    tables: dict[str, DataFrame]
    rejects: DataFrame
    summary: DataFrame
    changes_by_table: DataFrame
    lines: int
    rejected: int


def run(
    spark: SparkSession,
    input_path: str,
    masters: Masters,
    root: str,
    cfg: MatchConfig,
    prefix: str = "EMPLOYERS",
    retries: int = 0,
    job: str | None = None,
) -> RunResult | None:
    """Process one batch and publish its output and master snapshots under ``root``.

    None if there is nothing to match; if there were lines, all rejected, the attempt's folder still gets the rejects and
    the summary, while what is published stays as it was. Every attempt has its own folders, for what it publishes and for its stages, so
    neither a rerun nor a batch beside it touches what others wrote; the stages go when it ends. The published
    outputs change only with the last step, and only if no other run has published since the masters were read (since this
    call began, if they are not from ``read_masters``): else ``publish.Conflict`` is raised. With ``retries``, published masters are
    read again instead and the records, which stay staged, are matched with them.

    ``job`` names the batch: if it fails, its finished stages stay, and the next call of that name, with the same files,
    settings and library, goes on after them (matching only with the masters of the same published run; others are matched again).
    """
    attempt = uuid4().hex
    version = masters.version if isinstance(masters, PublishedMasters) else publish.last(spark, root)
    lines = intake.read_lines(spark, input_path)
    made_of = {"files": file_marks(spark, lines.inputFiles()), "settings": repr(cfg)} if job else None
    with stages_of(spark, f"job-{job}" if job else attempt, made_of):
        taken = intake.take_in(lines, cfg)
        if not taken.lines:
            return None
        label = publish.label_of_file(spark, taken.first_file, cfg.run_ts, prefix)
        folder = f"{root}/snapshots/{label}/{attempt}"
        if taken.lines == taken.rejected:
            nothing = spark.createDataFrame([], "cls string")
            summary = assemble.run_summary(nothing, taken.lines, taken.rejected)
            publish.write_snapshots({"rejects": taken.rejects, "summary": summary}, folder)
            intake.write_rejects(taken.rejects, f"{folder}/{REJECTS_CSV}")
            return None
        while True:
            try:
                paths, seq = _publish_batch(spark, taken, masters, version, root, label, attempt, cfg)
                break
            except publish.Conflict:
                if not retries or not isinstance(masters, PublishedMasters):
                    raise
                masters, retries, attempt = read_masters(spark, root), retries - 1, uuid4().hex
                version = masters.version

    written = {name: spark.read.parquet(paths[name]) for name in ("enriched", "rejects", "summary", "changes")}
    done = publish.published(spark, root, seq)
    tables = {
        name: publish.read_paths(
            spark, StructType.fromJson(json.loads(done.schemas[name])), list(publish.bucket_paths(done, name).values())
        )
        for name in FIELD_OF
    }
    return RunResult(
        label=label,
        attempt=attempt,
        output=written["enriched"],
        tables=tables,
        rejects=written["rejects"],
        summary=written["summary"],
        changes_by_table=written["changes"],
        lines=taken.lines,
        rejected=taken.rejected,
    )


def _publish_batch(
    spark: SparkSession,
    taken: intake.Intake,
    masters: Masters,
    version: int,
    root: str,
    label: str,
    attempt: str,
    cfg: MatchConfig,
) -> tuple[dict[str, str], int]:
    """Match staged records with the masters of a version and publish the result as the next one."""
    folder = f"{root}/snapshots/{label}/{attempt}"
    if publish.last(spark, root) != version:
        raise publish.Conflict(f"the masters read are those of run {version}")
    part_of_job(f"masters-{version}" if isinstance(masters, PublishedMasters) else attempt)
    limited = masters.limited(taken.records, cfg)
    outcome = match(taken.records, limited, cfg)
    main = stage(deciding_table(taken.records, outcome, cfg), "main")
    changes = {name: stage(df, f"changes_{name}") for name, df in change_sets(main, limited, cfg).items()}
    counts = [merge.change_counts(name, df) for name, df in changes.items()]
    results = {
        "enriched": enriched(taken.records, outcome, cfg),
        "rejects": taken.rejects,
        "summary": assemble.run_summary(outcome, taken.lines, taken.rejected),
        "changes": reduce(DataFrame.unionByName, counts),
    }
    paths, layout = write_masters(masters, limited, changes, folder, cfg)
    paths |= publish.write_snapshots(results, folder)
    if taken.rejected:
        paths[REJECTS_CSV] = f"{folder}/{REJECTS_CSV}"
        intake.write_rejects(taken.rejects, paths[REJECTS_CSV])
    return paths, publish.publish(spark, root, label, attempt, cfg.run_ts, paths, version, layout)
