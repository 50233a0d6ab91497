"""URL filter by a sort-merge range join over reversed-host keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Keys that are taken, in hash order, to find the ends of the sweep's cells; a bound of its own.
SAMPLE = 4096
#: The byte after every UTF-8 text: it closes the interval of a prefix.
LAST = b"\xff"
DEFAULT = "allow"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty where the url is null or has no ``://``."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, url.substr(begin + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def key(host: Column, path: Column) -> Column:
    """Reversed host, a slash, which no host holds, and the path: a rule's key is a prefix of what it fits."""
    return F.concat(reversed_host(host), F.lit("/"), path)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules from a short list of (host, path, verdict)."""
    if not rules:
        return spark.sql("select '' as host, '' as path, '' as verdict where false")
    named = [F.struct(*(F.lit(v).cast("string").alias(n) for n, v in zip(("host", "path", "verdict"), rule, strict=True))) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*named)))


def boundaries(rules: DataFrame) -> DataFrame:
    """at (binary), closes, rule: where the innermost active rule changes, and to which, in key order.

    A prefix is the interval from its key to its key and a byte above all others. Intervals are nested or apart,
    so a sweep over them keeps a stack: an opening puts its rule on top, a closing brings its parent back. The
    parent is the longest other key that is a prefix, found by an equality join over the rule's own prefixes. Of
    rules with the same host and path one stays, block before allow; rules with a null host or path are left out.
    """
    unique = rules.where("host is not null and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    unique = unique.withColumn("k", key(F.col("host"), F.col("path")))
    rule = F.struct((F.length("host") + F.length("path")).alias("length"), F.length("host").alias("of_host"), F.concat("host", "path").alias("rule"), "verdict")
    unique = unique.select("k", rule.alias("rule"))
    shorter = F.transform(F.sequence(F.lit(1), F.length("k") - 1), lambda n: F.substring(F.col("k"), F.lit(1), n))
    inner = unique.where(F.length("k") > 1).select("k", F.explode(shorter).alias("p"))
    parents = inner.join(unique.select(F.col("k").alias("p"), F.col("rule").alias("up")), "p").groupBy("k").agg(F.max_by("up", F.length("p")).alias("up"))
    opening = unique.select(F.col("k").cast("binary").alias("at"), F.lit(False).alias("closes"), "rule")
    closing = unique.join(parents, "k", "left").select(F.concat(F.col("k").cast("binary"), F.lit(LAST)).alias("at"), F.lit(True).alias("closes"), F.col("up").alias("rule"))
    return opening.unionByName(closing)


def cell_of(at: Column, ends: list[bytes], spread: Column) -> Column:
    """Number of ends up to ``at``, found in two steps; rows at an end that occurs repeatedly are dealt over its cells."""
    if not ends:
        return F.lit(0)
    step = max(1, int(len(ends) ** 0.5))
    groups = [ends[i:i + step] for i in range(0, len(ends), step)]
    heads = F.array(*(F.lit(g[0]) for g in groups))
    table = F.array(*(F.array(*(F.lit(e) for e in g)) for g in groups))

    def count(test) -> Column:
        group = F.size(F.filter(heads, test))
        return F.when(group == 0, 0).otherwise((group - 1) * step + F.size(F.filter(F.element_at(table, F.greatest(group, F.lit(1))), test)))

    low, high = count(lambda e: e < at), count(lambda e: e <= at)
    return low + F.pmod(spread, high - low + 1).cast("int")


def probes(rows: DataFrame, depth: int) -> DataFrame:
    """``rows`` (url, ...) with host and path, and ``at``: a row per level of the host, of the last ``depth`` ones."""
    host, path = url_parts(F.col("url"))
    labels = F.split("host", r"\.", -1)
    levels = F.transform(F.sequence(F.greatest(F.size(labels) - depth + 1, F.lit(1)), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    levelled = rows.withColumn("host", host).withColumn("path", path).withColumn("level", F.explode(levels))
    return levelled.withColumn("at", key(F.col("level"), F.col("path")).cast("binary")).drop("level")


def cell_ends(pages: DataFrame, depth: int, cells: int, id_col: str = "page_id", url_col: str = "url") -> list[bytes]:
    """Keys that cut the probes into about ``cells`` cells, even by a sample of ``SAMPLE`` probes; a heavy key ends several."""
    hashed = pages.select(F.col(url_col).alias("url"), F.xxhash64(id_col, url_col).alias("h"))
    # about twice the sample passes the hash test, so no task sends more than its share of it; repeated rows are one
    hashed = hashed.where(F.pmod(F.col("h"), F.lit(max(1, pages.count() // (2 * SAMPLE)))) == 0).distinct()
    asked = probes(hashed, depth).select("at", F.xxhash64("h", "at").alias("h"))
    sample = sorted(bytes(r["at"]) for r in asked.orderBy("h").limit(SAMPLE).collect())
    every = max(1, len(sample) // cells)
    return sample[every // 2::every]


def url_verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    A rule (host, path, verdict) fits its host and all subdomains if the path starts with the rule's. The longest
    rule wins, host and path counted together, then the longer host. Without one the verdict is ``allow``.

    Each url is probed once per level of its host, up to the depth of the deepest rule. Probes and rule boundaries are
    swept together in key order: the last boundary before a probe names the innermost rule. The key range is cut into
    cells at a bounded sample of the probes, a heavy key being dealt over several cells, and every cell starts with
    the rule then active, so cells are swept apart and no host or url gathers in a task. Rows alike in id and url are
    probed once and counted. Null or odd urls get an empty host and path, which no rule with a host fits.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).groupBy("page_id", "url").agg(F.count("*").alias("n"))
    depth = rules.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 1
    ends = cell_ends(pages, depth, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), id_col, url_col)

    bounds = boundaries(rules)
    cells = spark.range(1, len(ends) + 1).select(F.col("id").cast("int").alias("cell")) if ends else spark.range(0).select(F.col("id").cast("int").alias("cell"))
    starts = cells.withColumn("start", F.element_at(F.array(*(F.lit(e) for e in ends)) if ends else F.array(F.lit(b"")), F.col("cell")))
    # the rule active where a cell starts: the innermost of those that began before it and have not ended
    spans = bounds.where("not closes").select("at", F.concat("at", F.lit(LAST)).alias("to"), "rule")
    active = spans.withColumn("from_cell", cell_of(F.col("at"), ends, F.lit(0))).withColumn("to_cell", cell_of(F.col("to"), ends, F.lit(0)))
    active = active.withColumn("cell", F.explode(F.when(F.col("to_cell") > F.col("from_cell"), F.sequence(F.col("from_cell") + 1, "to_cell")).otherwise(F.array().cast("array<int>"))))
    top = active.groupBy("cell").agg(F.max_by("rule", F.length("at")).alias("rule"))
    first = starts.join(top, "cell", "left").select("cell", F.lit(None).cast("binary").alias("at"), F.lit(0).alias("kind"), "rule")
    inside = bounds.select(F.explode(F.sequence(cell_of(F.col("at"), ends, F.lit(0)), _last_cell(F.col("at"), ends))).alias("cell"), "at", F.lit(1).alias("kind"), "rule")
    asked = probes(rows, depth).select(cell_of(F.col("at"), ends, F.xxhash64("page_id", "url")).alias("cell"), "at", F.lit(2).alias("kind"), "page_id", "url", "host", "path", "n")
    events = first.unionByName(inside).withColumn("known", F.struct("rule")).drop("rule").unionByName(asked, allowMissingColumns=True)
    # a boundary comes before the probes at its key
    sweep = Window.partitionBy("cell").orderBy(F.col("at").asc_nulls_first(), "kind")
    swept = events.withColumn("state", F.last("known", ignorenulls=True).over(sweep)).where("kind = 2")
    best = swept.groupBy("page_id", "url").agg(F.max("state.rule").alias("best"), F.first("host").alias("host"), F.first("path").alias("path"), F.first("n").alias("n"))
    verdict = F.coalesce(F.col("best.verdict"), F.lit(DEFAULT))
    copies = F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"), copies.alias("_copy")).drop("_copy")


def _last_cell(at: Column, ends: list[bytes]) -> Column:
    return F.size(F.filter(F.array(*(F.lit(e) for e in ends)), lambda e: e <= at)) if ends else F.lit(0)
