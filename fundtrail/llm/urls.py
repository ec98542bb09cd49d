"""URL filter: host and path rules, then a path-template tree with labelled purity.

Rules: a rule is a host suffix with a path prefix and a verdict; the longest
that fits a url wins.

Templates, for urls without a rule: every host has a tree of path templates. A
segment that looks variable (digits, hashes, dates, long mixtures) becomes a
wildcard of its kind, as does any segment below a node with many different
children. Branches of a node whose labelled shares do not differ statistically
merge into one, which the others of the node do not count in. The purity of a
template is its share of bad labelled urls, smoothed towards the template's
share over all hosts and, above that, towards the overall share. A template of
enough bad purity is rejected when its branch has labelled urls of its own, or
when it has none and the template is labelled on several other hosts, whose
share then decides.

Labels come from the caller as (url, bad); the registered query uses the
verdicts of the rules on the urls they fit. The trees are
built from the distinct (host, segments) of the urls, and every count is an
aggregate with map-side combining, so a hot host is one row of counts per
template.

Edge cases: a null url, or one without ``://``, has an empty host and path and
is judged like any other; repeated urls count as often as they occur; without
labels the smoothed share is the prior and nothing is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_DEPTH = 6
#: A node with more different children than this is variable below.
FAN_OUT = 30
PRIOR_WEIGHT = 4.0
REJECT_PURITY = 0.7
#: A host's template needs so many labelled urls of its own (merged branches count) to be rejected.
MIN_LABELLED = 3
#: Without any, the share over all hosts decides if the template has so many labelled urls on so many hosts.
MIN_SHARED, MIN_HOSTS = 20, 3
#: Branches differ when their shares are further apart than so many standard errors.
MERGE_DEVIATIONS = 2.0
DEFAULT_SHARE = 0.1


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` (after the first ``://``, A-Z lower-cased) and ``path`` (up to ``?`` or ``#``)."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    has = F.contains(url, F.lit("://"))
    rest = F.when(has, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return pages.withColumn("host", F.translate(host, capitals, capitals.lower())).withColumn("path", path)


def rule_for(rules: list[UrlRule]) -> Column:
    """The longest rule that fits ``host`` and ``path``: struct(rule, verdict), or null.

    Ties in length go to the rule with the longer host, then to the earlier one.
    """
    order = sorted(rules, key=lambda r: (-len(r.text), -len(r.host)))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(order):
        on_host = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
        fits = on_host & F.startswith(F.col("path"), F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _kind(segment: Column) -> Column:
    """A segment, or the wildcard of its kind when it looks variable."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    end = F.lower(F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1))
    wild = (
        F.when(F.rlike(stem, F.lit(r"^\d+$")), F.lit("<num>"))
        .when(F.rlike(stem, F.lit(r"^\d{4}-\d{1,2}(-\d{1,2})?$")), F.lit("<date>"))
        .when(F.rlike(stem, F.lit(r"^[0-9a-fA-F]{8,}$")), F.lit("<hex>"))
        .when(F.rlike(stem, F.lit(r"^(?=.*\d)[\w-]{12,}$")), F.lit("<id>"))
    )
    return F.when(wild.isNotNull(), F.concat(wild, end)).otherwise(segment)


def _levels(urls: DataFrame) -> DataFrame:
    """Adds ``segments``: the kinds of the first ``MAX_DEPTH`` path segments, then one place for all the rest."""
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    kinds = F.transform(F.slice(parts, 1, MAX_DEPTH), _kind)
    deeper = F.size(parts) > MAX_DEPTH
    return urls.withColumn("segments", F.when(deeper, F.concat(kinds, F.array(F.lit("<rest>")))).otherwise(kinds))


def with_templates(urls: DataFrame) -> DataFrame:
    """Adds ``template`` (path below the host) to rows with ``host`` and ``path``.

    The trees hold the distinct (host, segments) only. A node with more than
    ``FAN_OUT`` different children gets one wildcard child.
    """
    rows = _levels(urls).withColumn("leaf", F.array_join("segments", "/"))
    leaves = rows.select("host", "leaf", "segments").distinct()
    steps = leaves.select("host", "leaf", "segments", F.posexplode("segments").alias("level", "child")).select(
        "host",
        "leaf",
        "level",
        "child",
        F.array_join(F.slice("segments", F.lit(1), F.col("level")), "/").alias("prefix"),
    )
    wide = (
        steps.select("host", "level", "prefix", "child")
        .distinct()
        .groupBy("host", "level", "prefix")
        .agg(F.count(F.lit(1)).alias("children"))
        .where(F.col("children") > FAN_OUT)
        .select("host", "level", "prefix", F.lit("<any>").alias("wild"))
    )
    templates = (
        steps.join(wide, ["host", "level", "prefix"], "left")
        .groupBy("host", "leaf")
        # at most MAX_DEPTH + 1 steps
        .agg(F.array_sort(F.collect_list(F.struct("level", F.coalesce("wild", "child").alias("piece")))).alias("steps"))
        .select(
            "host",
            "leaf",
            F.concat(F.lit("/"), F.array_join(F.transform("steps", lambda x: x["piece"]), "/")).alias("template"),
        )
    )
    return (
        rows.join(templates, ["host", "leaf"], "left")
        .withColumn("template", F.coalesce("template", F.lit("")))
        .drop("segments", "leaf")
    )


def template_purity(rows: DataFrame) -> DataFrame:
    """(host, template, purity, labelled, shared, hosts) from rows with ``host``, ``template`` and ``bad`` (null where unlabelled)."""
    counts = rows.groupBy("host", "template").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad")
    )
    overall = counts.agg(
        F.coalesce(F.sum("bad") / F.when(F.sum("n") > 0, F.sum("n")), F.lit(DEFAULT_SHARE)).alias("overall")
    )
    shared = counts.groupBy("template").agg(
        F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"), F.count_if(F.col("n") > 0).alias("hosts")
    )
    named = counts.join(shared, "template").withColumn(
        "prior", (F.col("all_bad") + PRIOR_WEIGHT * overall.scalar()) / (F.col("all_n") + PRIOR_WEIGHT)
    )
    # siblings under one parent that do not differ from the parent's share merge into one branch
    parent = F.regexp_replace("template", r"/[^/]*$", "")
    family = Window.partitionBy("host", "parent")
    named = (
        named.withColumn("parent", parent)
        .withColumn("family_n", F.sum("n").over(family))
        .withColumn("family_bad", F.sum("bad").over(family))
    )
    share = F.col("bad") / F.greatest(F.col("n"), F.lit(1))
    family_share = F.col("family_bad") / F.greatest(F.col("family_n"), F.lit(1))
    error = F.sqrt(family_share * (1 - family_share) / F.greatest(F.col("n"), F.lit(1))) + F.lit(1e-9)
    alike = (F.col("n") == 0) | (F.abs(share - family_share) <= MERGE_DEVIATIONS * error)
    branch = Window.partitionBy("host", "parent", "alike")
    named = (
        named.withColumn("alike", alike)
        .withColumn("branch_n", F.sum("n").over(branch))
        .withColumn("branch_bad", F.sum("bad").over(branch))
    )
    n = F.when(F.col("alike"), F.col("branch_n")).otherwise(F.col("n"))
    bad = F.when(F.col("alike"), F.col("branch_bad")).otherwise(F.col("bad"))
    return named.select(
        "host",
        "template",
        ((bad + PRIOR_WEIGHT * F.col("prior")) / (n + PRIOR_WEIGHT)).alias("purity"),
        n.alias("labelled"),
        F.col("all_n").alias("shared"),
        "hosts",
    )


def filter_urls(
    pages: DataFrame, rules: list[UrlRule], id_col: str = "page_id", url_col: str = "url", labels: DataFrame | None = None
) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) per row.

    ``labels``: optional (id, bad) rows; without them the rules' verdicts label
    the urls that they fit.
    """
    base = with_host_and_path(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), "url")
    base = base.withColumn("fit", rule_for(rules))
    if labels is None:
        base = base.withColumn("bad", F.when(F.col("fit").isNotNull(), (F.col("fit.verdict") == "block").cast("int")))
    else:
        known = labels.select(F.col(id_col).alias("id"), "bad").groupBy("id").agg(F.max("bad").alias("bad"))
        base = base.join(known, "id", "left")
    rows = with_templates(base)
    purity = template_purity(rows)
    judged = rows.join(purity, ["host", "template"], "left")
    elsewhere = (F.col("labelled") == 0) & (F.col("shared") >= MIN_SHARED) & (F.col("hosts") >= MIN_HOSTS)
    impure = (F.col("purity") >= REJECT_PURITY) & ((F.col("labelled") >= MIN_LABELLED) | elsewhere)
    own = F.when(impure, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), own).alias("verdict"),
        "template",
        "purity",
    )
