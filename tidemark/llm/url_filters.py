"""URL filters: listed rules first, then a tree of path templates judged by labelled purity.

Listed rules hold for a host and its subdomains and for paths that start with the rule's path; the
longest rule that fits decides. Every other URL is judged by the template of its path:

* A segment whose form varies by nature (digits, hexadecimal, long mixes of letters and digits,
  before any file ending) is a wildcard of that form.
* Any other segment is a branch below its host and the template of the segments before it. A branch
  whose share of good labels is like that of its siblings is merged into the wildcard ``*``. Labels
  alone decide: a branch stands out if the likelihood ratio of two shares against one is at least
  ``ln(2 m / ALPHA)``, with m the number of siblings that have labels. That bound holds for few labels
  as for many, and for all siblings of a node together.
* Levels are merged from the top. What hangs below merged branches hangs below their wildcard and is
  counted together there before it is tested. Segments beyond ``DEPTH`` are one wildcard ``**``.
* A template's purity is its share of good labels, smoothed with ``WEIGHT`` labels of its host's
  purity, which is smoothed with as many of the whole table's. Below ``PURITY`` it is rejected.

Everything is counted on distinct (host, path) pairs with their labels summed, and every sum is
written before it is joined: small ones are broadcast by their size, and where a host, a branch or a
template holds many rows, Spark splits its partition. All expressions are Spark's own.

A null URL, or one without ``://``, has empty host and path, no rule fits it, and it is judged as
the pages of the empty host are. An empty path has no segments, a very long one is judged whole.
Repeated rows are judged each. Null labels are none; of several labels of a page the bad one counts.
Equally long rules are tried in alphabetical order, the last one that fits wins. No labels block
nothing beyond the rules; no pages give no rows. Only page_id and url are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import save_shared

# (verdict, host, path): the path includes its slash.
Rule = tuple[str, str, str]

ALPHA = 0.001
DEPTH = 6
WEIGHT = 5.0
PURITY = 0.5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host from the first ``://`` up to ``/ ? #``, path from there up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return (
        F.translate(host, _UPPER, _UPPER.lower()),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def listed(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The rule that fits (null if none) and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = (
            (F.col("host") == host) | F.col("host").endswith("." + host)
        ) & F.col("path").startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _form(segment: Column) -> Column:
    """The wildcard of a segment that varies by nature, else the segment."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z][A-Za-z0-9]{0,4}$", "")
    digits = F.length(F.regexp_replace(stem, "[^0-9]", ""))
    form = (
        F.when(stem.rlike(r"^[0-9]+([-_.][0-9]+)*$"), F.lit("{n}"))
        .when(stem.rlike(r"^[0-9a-fA-F-]{8,}$") & (digits > 0), F.lit("{hex}"))
        .when((F.length(stem) >= 12) & (digits >= 3), F.lit("{id}"))
    )
    return F.when(form.isNotNull(), F.concat(form, F.lower(ending))).otherwise(segment)


def _entropy(good: Column, n: Column) -> Column:
    """n times the entropy of a share, in nats."""
    bad = n - good
    return -sum(
        F.when(part > 0, part * F.log(F.try_divide(part, n))).otherwise(0.0) for part in (good, bad)
    )


def stands_out() -> Column:
    """Whether a branch's share of good labels differs from that of its siblings together."""
    n, good, all_n, all_good = map(F.col, ("labelled", "good", "all_labelled", "all_good"))
    ratio = _entropy(all_good, all_n) - _entropy(good, n) - _entropy(all_good - good, all_n - n)
    both = (n > 0) & (all_n > n)
    return both & (ratio >= F.log(2.0 * F.col("siblings") / ALPHA))


def _kept_branches(placed: DataFrame) -> DataFrame:
    """``host, prefix, segment`` of the branches of one level that keep their name."""
    counts = ("labelled", "good")
    branches = save_shared(
        placed.groupBy("host", "prefix", "segment").agg(*[F.sum(c).alias(c) for c in counts]),
        "branches",
    )
    parents = save_shared(
        branches.groupBy("host", "prefix").agg(
            *[F.sum(c).alias(f"all_{c}") for c in counts],
            F.count_if(F.col("labelled") > 0).alias("siblings"),
        ),
        "parents",
    )
    by_nature = F.col("segment").startswith("{")
    kept = branches.join(parents, ["host", "prefix"]).filter(by_nature | stands_out())
    return save_shared(kept.select("host", "prefix", "segment"), "kept")


def path_templates(paths: DataFrame) -> DataFrame:
    """A written table ``host, path, labelled, good`` with the ``template`` of each path, written."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    state = save_shared(
        paths.select(
            "host", "path", "labelled", "good", F.transform(segments, _form).alias("forms"),
            F.lit("").alias("prefix"),
        ),
        "forms",
    )
    levels = state.agg(F.max(F.size("forms"))).first()[0] or 0
    for depth in range(min(levels, DEPTH)):
        placed = state.withColumn("segment", F.get("forms", F.lit(depth)))
        kept = _kept_branches(placed.filter(F.col("segment").isNotNull()))
        shown = kept.withColumn("shown", F.col("segment"))
        joined = placed.join(shown, ["host", "prefix", "segment"], "left")
        step = F.concat_ws("/", "prefix", F.coalesce("shown", F.lit("*")))
        prefix = F.when(F.col("segment").isNull(), F.col("prefix")).otherwise(step)
        state = save_shared(
            joined.select("host", "path", "labelled", "good", "forms", prefix.alias("prefix")),
            "forms",
        )
    rest = F.when(F.size("forms") > DEPTH, F.lit("/**")).otherwise("")
    template = F.when(F.col("prefix") == "", F.lit("/")).otherwise(F.concat("prefix", rest))
    return save_shared(
        state.select("host", "path", "labelled", "good", template.alias("template")), "templates"
    )


def template_purity(counted: DataFrame) -> DataFrame:
    """``host, template, purity`` of a written table ``host, path, labelled, good, template``."""
    by_template = save_shared(
        counted.groupBy("host", "template").agg(
            F.sum("labelled").alias("labelled"), F.sum("good").alias("good")
        ),
        "by-template",
    )
    by_host = save_shared(
        by_template.groupBy("host").agg(
            F.sum("labelled").alias("host_labelled"), F.sum("good").alias("host_good")
        ),
        "by-host",
    )
    labelled, good = by_host.agg(F.sum("host_labelled"), F.sum("host_good")).first()
    whole = good / labelled if labelled else 1.0
    prior = (F.col("host_good") + WEIGHT * whole) / (F.col("host_labelled") + WEIGHT)
    purity = (F.col("good") + WEIGHT * prior) / (F.col("labelled") + WEIGHT)
    found = by_template.join(by_host, "host").select("host", "template", purity.alias("purity"))
    return save_shared(found, "purity")


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of every page.

    ``labels`` has ``page_id`` and ``good``, a boolean.
    """
    host, path = host_and_path(F.col("url"))
    placed = save_shared(
        pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path")),
        "pages",
    )
    marks = save_shared(
        labels.filter(F.col("good").isNotNull()).groupBy("page_id").agg(
            F.min("good").alias("good")
        ),
        "marks",
    )
    known = placed.join(marks, "page_id", "left")
    paths = save_shared(
        known.groupBy("host", "path").agg(
            F.count("good").alias("labelled"),
            F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good"),
        ),
        "paths",
    )
    templates = path_templates(paths)
    purity = template_purity(templates)
    judged = save_shared(
        templates.select("host", "path", "template").join(purity, ["host", "template"]), "judged"
    )
    rule, verdict = listed(rules)
    method = F.when(F.col("purity") < PURITY, "block").otherwise("allow")
    return (
        placed.join(judged, ["host", "path"])
        .withColumns({"rule": rule, "verdict": F.coalesce(verdict, method)})
        .select("page_id", "host", "path", "rule", "verdict", "template", "purity")
    )


def labels_by_path(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels of the documents that the pages show: the last number of a path is a doc_id.

    A page is good if its document is of good quality and not toxic.
    """
    _, path = host_and_path(F.col("url"))
    doc_id = F.regexp_extract(path, r"([0-9]{1,18})[^0-9]*$", 1)
    shown = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.when(doc_id != "", doc_id).cast("long").alias("doc_id"),
    )
    marks = save_shared(
        labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            F.min("quality").alias("quality"), F.max("toxic").alias("toxic")
        ),
        "document-marks",
    )
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return shown.join(marks, "doc_id").select("page_id", good.alias("good"))
