"""URL filters: host and path rules, and a tree of path templates for what no rule decides.

All of it is DataFrame expressions. Per host, a segment that holds too small a share of the pages under its
prefix becomes a wildcard, level by level. Pages that a rule decides are the labelled ones; templates that differ in their last
literal segment only are branches of one parent, and those whose blocked shares do not differ by a test on their counts are merged.
A template is rejected if the smoothed share of blocked pages among the labelled ones it was merged with is high.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.common import lower_ascii
from ledgerlink.staging import stage


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
# So many levels are found in one plan; deeper ones are staged round by round.
LEVELS = 3
# A segment stands for itself with this many pages and one of this many parts of its prefix's pages, so a parent has at most
# that many literal branches.
LITERAL_PAGES, LITERAL_PART = 3, 20
# Two blocked shares differ if the square of the two-proportion statistic is above this (5 % level).
ALIKE = 3.84
REJECT = 0.8


def parts(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """(id, host, path) of every page."""
    url = F.col(url_col).cast("string")
    rest = F.when(F.locate("://", url) > 0, F.expr(f"substring(cast(`{url_col}` as string), locate('://', `{url_col}`) + 3)"))
    wide = pages.select(F.col(id_col), rest.alias("_rest"))
    host = F.coalesce(F.expr(lower_ascii("regexp_extract(_rest, '^([^/?#]*)', 1)")), F.lit(""))
    path = F.coalesce(F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return wide.select(id_col, host.alias("host"), path.alias("path"))


def decide(rules: Sequence[Rule], value: str) -> Column:
    """``value`` ('text' or 'verdict') of the longest rule that fits ``host`` and ``path``; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        at = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        out = F.when(at & F.col("path").startswith(rule.path), F.lit(getattr(rule, value))).otherwise(out)
    return out


def segments() -> Column:
    return F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(F.split(F.expr("substring(path, 2)"), "/"))


def own_segment(segment: Column) -> Column:
    """Digits only are variable wherever they stand."""
    return F.when(~segment.rlike("^[0-9]+$"), segment)


def one_level(rows: DataFrame) -> DataFrame:
    """``rows`` with one more segment, or wildcard, in ``template`` and ``shape``; ``_at`` counts those that are in."""
    segment = F.get(segments(), F.col("_at"))
    rows = rows.withColumn("_more", segment.isNotNull()).withColumn("_own", own_segment(segment))
    under = rows.filter("_more").groupBy("template", "_own").agg(F.count("*").alias("n"))
    of = under.groupBy("template").agg(F.sum("n").alias("total"))
    literal = under.filter("_own IS NOT NULL").join(of, "template")
    literal = literal.filter((F.col("n") >= LITERAL_PAGES) & (F.col("n") * LITERAL_PART >= F.col("total")))
    literal = literal.select("template", "_own", F.col("_own").alias("_literal"))
    rows = rows.join(literal, ["template", "_own"], "left")
    step = F.coalesce("_literal", F.lit("*"))
    mark = F.when(F.col("_literal").isNotNull(), "/#").otherwise("/*")
    rows = rows.withColumns(
        {
            "template": F.when(F.col("_more"), F.concat("template", F.lit("/"), step)).otherwise(F.col("template")),
            "shape": F.when(F.col("_more"), F.concat("shape", mark)).otherwise(F.col("shape")),
            "_at": F.when(F.col("_more"), F.col("_at") + 1).otherwise(F.col("_at")),
        }
    )
    return rows.drop("_more", "_own", "_literal")


def common_run(first: Column, last: Column) -> Column:
    """The segments that the first and the last of some sorted paths begin with, and so all between."""
    same = F.zip_with(first, last, lambda x, y: F.coalesce(x == y, F.lit(False)))
    end = F.array_position(same, False).cast("int")
    return F.slice(first, F.lit(1), F.when(end == 0, F.size(same)).otherwise(end - 1))


def templates(pages: DataFrame) -> DataFrame:
    """``pages`` with ``template`` (host and segments or wildcards) and ``shape`` (which are which), staged.

    The tree ends where its paths do. A template with fewer pages below it than a literal segment needs has only wildcards from
    there on, and segments that all pages of a template share are taken in one step, so beyond ``LEVELS`` there are as many rounds
    as places on one path where pages part or end.
    """
    rows = pages.withColumns({"template": F.col("host"), "shape": F.lit(""), "_at": F.lit(0)})
    for _ in range(LEVELS):
        rows = one_level(rows)
    rows, deeper = stage(rows, "templates"), F.size(segments()) > F.col("_at")
    done, rows = rows.filter(~deeper), rows.filter(deeper)
    while not rows.isEmpty():
        left = F.slice(segments(), F.col("_at") + 1, F.size(segments()))
        under = rows.groupBy("template").agg(F.count("*").alias("_below"), F.min(left).alias("_first"), F.max(left).alias("_last"))
        under = under.select("template", "_below", common_run(F.col("_first"), F.col("_last")).alias("_run"))
        rows = rows.join(under, "template")
        rest = F.repeat(F.lit("/*"), F.size(segments()) - F.col("_at"))
        few = rows.filter(F.col("_below") < LITERAL_PAGES).drop("_below", "_run")
        few = few.withColumns({c: F.concat(c, rest) for c in ("template", "shape")})
        steps = F.transform("_run", lambda s: F.concat(F.lit("/"), F.coalesce(own_segment(s), F.lit("*"))))
        marks = F.transform("_run", lambda s: F.when(own_segment(s).isNull(), "/*").otherwise("/#"))
        many = rows.filter(F.col("_below") >= LITERAL_PAGES).withColumns(
            {
                "template": F.concat("template", F.array_join(steps, "")),
                "shape": F.concat("shape", F.array_join(marks, "")),
                "_at": F.col("_at") + F.size("_run"),
            }
        )
        rows = stage(one_level(many.drop("_below", "_run")), "deep_templates")
        done = done.unionByName(few).unionByName(rows.filter(~deeper))
        rows = rows.filter(deeper)
    return done.drop("_at")


def family() -> Column:
    """The template without its last literal segment: what branches of one parent share, at most ``LITERAL_PART`` of them.

    Neither hosts nor paths hold a ``#``, so the mark is no segment.
    """
    marks = F.split("shape", "/")
    last = F.size(marks) - F.array_position(F.reverse(marks), "#")
    literal = F.array_contains(marks, "#")
    steps = F.transform(F.split("template", "/"), lambda s, i: F.when(literal & (i == last), "#").otherwise(s))
    return F.array_join(steps, "/")


def differ(n: Column, b: Column, m: Column, c: Column) -> Column:
    """Whether ``b`` of ``n`` and ``c`` of ``m`` are different shares, without a division."""
    n, b, m, c = (x.cast("double") for x in (n, b, m, c))
    gap = b * m - c * n
    return gap * gap * (n + m) > F.lit(ALIKE) * (b + c) * (n + m - b - c) * n * m


def merged_branches(stats: DataFrame) -> DataFrame:
    """(template, labelled, blocked): each template with the counts of the branches it is merged with.

    The branches of a parent are taken by falling share, the larger first among equals; one joins the run before it unless its share differs from the
    whole run's. A parent has a bounded number of branches, so a run is found within one row.
    """
    share = F.col("blocked").cast("double") / F.col("labelled")
    branch = F.struct((-share).alias("order"), (-F.col("labelled")).alias("size"), "template", "labelled", "blocked")
    rows = stats.groupBy("host", "shape", family().alias("_family")).agg(F.array_sort(F.collect_list(branch)).alias("_branches"))
    run = "array<struct<labelled: bigint, blocked: bigint, templates: array<string>>>"

    def join(runs: Column, new: Column) -> Column:
        alone = F.struct(new["labelled"].alias("labelled"), new["blocked"].alias("blocked"), F.array(new["template"]).alias("templates"))
        old = F.element_at(runs, -1)
        both = F.struct(
            (old["labelled"] + new["labelled"]).alias("labelled"),
            (old["blocked"] + new["blocked"]).alias("blocked"),
            F.concat(old["templates"], F.array(new["template"])).alias("templates"),
        )
        begins = (F.size(runs) == 0) | differ(old["labelled"], old["blocked"], new["labelled"], new["blocked"])
        before = F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0)))
        return F.when(begins, F.concat(runs, F.array(alone))).otherwise(F.concat(before, F.array(both))).cast(run)

    runs = rows.select(F.explode(F.aggregate("_branches", F.array().cast(run), join)).alias("_run"))
    return runs.select(F.explode("_run.templates").alias("template"), "_run.labelled", "_run.blocked")


def rejected(rows: DataFrame, reject: float) -> DataFrame:
    """The templates that are rejected, from pages with their template and the verdict of a rule, if any."""
    labelled, blocked = F.count("ruled").alias("labelled"), F.count_if(F.col("ruled") == "block").alias("blocked")
    stats = rows.groupBy("host", "template", "shape").agg(labelled, blocked).filter("labelled > 0")
    share = (F.col("blocked") + 1) / (F.col("labelled") + 2)
    return merged_branches(stats).filter(share >= reject).select("template", F.lit("block").alias("judged")).distinct()


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    reject: float = REJECT,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict, template) of every page.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest one decides. Other pages are
    blocked if their template is rejected, else allowed; a template without labelled pages is never
    rejected. A url that is null or has no ``://`` has an empty host and path, fits no rule and is allowed. Repeated rows are judged
    each and count each; a null id stays null; other columns are not looked at; an empty table gives no rows.

    Counts are pre-aggregated and joined back, so a host with a third of all pages is a join key that Spark
    splits, never one task's group.
    """
    rows = parts(pages, id_col, url_col)
    rows = rows.withColumn("rule", decide(rules, "text")).withColumn("ruled", decide(rules, "verdict"))
    rows = templates(rows)
    judged = rows.join(rejected(rows, reject), "template", "left")
    verdict = F.coalesce("ruled", "judged", F.lit("allow")).alias("verdict")
    return judged.select(id_col, "host", "path", "rule", verdict, "template")


def url_verdicts_sql(rules: Sequence[Rule] = RULES, reject: float = REJECT) -> str:
    """DuckDB SQL for ``url_verdicts`` over ``pages``."""
    fits = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{{}}{r.text}'"
        for r in sorted(rules, key=lambda r: -len(r.text))
    )
    verdict = " ".join(f"WHEN '{r.text}' THEN '{r.verdict}'" for r in rules)
    return f"""
WITH RECURSIVE u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id,
        coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
f AS (SELECT *, CASE {fits.replace('{}', '')} END AS rule FROM p),
r0 AS (SELECT *, CASE rule {verdict} END AS ruled, host AS template, '' AS shape,
         CASE WHEN path = '' THEN [] ELSE string_split(substr(path, 2), '/') END AS segs, 0 AS lev FROM f),
r AS (SELECT page_id, host, path, rule, ruled, template, shape, segs, lev FROM r0 UNION ALL
      SELECT page_id, host, path, rule, ruled, template || '/' || CASE WHEN lit THEN own ELSE '*' END,
             shape || CASE WHEN lit THEN '/#' ELSE '/*' END, segs, lev + 1
      FROM (SELECT *, own IS NOT NULL AND count(*) OVER (PARTITION BY template, own) >= {LITERAL_PAGES}
                   AND count(*) OVER (PARTITION BY template, own) * {LITERAL_PART} >= count(*) OVER (PARTITION BY template) AS lit
            FROM (SELECT *, CASE WHEN NOT regexp_full_match(segs[lev + 1], '[0-9]+') THEN segs[lev + 1] END AS own
                  FROM r WHERE len(segs) > lev))),
t AS (SELECT * FROM r WHERE len(segs) = lev),
g AS (SELECT host, template, shape, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS blocked FROM t GROUP BY ALL),
h AS (SELECT *, CASE WHEN contains(shape, '#') THEN len(string_split(shape, '/')) - list_position(list_reverse(string_split(shape, '/')), '#') + 1 END AS mark,
             string_split(template, '/') AS steps FROM g WHERE labelled > 0),
o AS (SELECT *, row_number() OVER (PARTITION BY host, shape, family ORDER BY blocked::DOUBLE / labelled DESC, labelled DESC, encode(template)) AS place
      FROM (SELECT *, CASE WHEN mark IS NULL THEN template
                           ELSE array_to_string(list_concat(list_concat(steps[:mark - 1], ['#']), steps[mark + 1:]), '/') END AS family FROM h)),
m AS (SELECT host, shape, family, place, template, place AS run, labelled::DOUBLE AS n, blocked::DOUBLE AS b FROM o WHERE place = 1 UNION ALL
      SELECT o.host, o.shape, o.family, o.place, o.template, CASE WHEN x THEN o.place ELSE run END,
             CASE WHEN x THEN o.labelled ELSE n + o.labelled END, CASE WHEN x THEN o.blocked ELSE b + o.blocked END
      FROM (SELECT m.*, l.labelled AS c, (b * l.labelled - l.blocked * n) * (b * l.labelled - l.blocked * n) * (n + l.labelled)
              > {ALIKE}::DOUBLE * (b + l.blocked) * (n + l.labelled - b - l.blocked) * n * l.labelled AS x
            FROM m JOIN o AS l ON l.host = m.host AND l.shape = m.shape AND l.family = m.family AND l.place = m.place + 1) AS z
      JOIN o ON o.host = z.host AND o.shape = z.shape AND o.family = z.family AND o.place = z.place + 1),
k AS (SELECT host, shape, family, run FROM m GROUP BY ALL HAVING (arg_max(b, place) + 1) / (arg_max(n, place) + 2) >= {reject}),
j AS (SELECT template FROM m SEMI JOIN k USING (host, shape, family, run))
SELECT page_id, host, path, rule, template,
       coalesce(ruled, CASE WHEN template IN (SELECT template FROM j) THEN 'block' END, 'allow') AS verdict FROM t
"""
