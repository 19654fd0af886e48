"""URL filters: a sort-merge join of urls with nested rules over reversed-host keys.

A rule is a host and the beginning of a path, `example.com/en/`. Its key is the host's labels in reverse, a slash, and the path:
`com.example//en/`. A url that fits it has, for as many of its host's last labels as the rule's host has, a key that begins
with the rule's, so a rule is an interval of sorted keys, and intervals are nested or apart. Urls send one key for each number
of labels that any rule has. Keys of rules and urls are dealt to ranges and sorted, and one sweep over a range keeps the stack
of rules whose interval is open: its top is the longest rule of that many labels.

Ranges are cut by (key, row), so a url that a third of all rows repeat is spread over many. A rule goes to every range that its
interval meets; as open intervals are nested, a cut has at most as many of them as its key is long.

Defined cases: a url without `://`, or null, has an empty host and path and fits no rule. Where no rule fits, a url with a host
is allowed and one without is blocked, for there is nothing to fetch it from. The longest rule counts by the code points of
host and path, of equals the one with more labels; a rule given with both verdicts blocks. Ids may be null or repeat: every
row has its own result. Rules that are null or have no verdict are ignored, and so are other columns.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm.common import stored, table

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sampled keys for each range, and the bytes of a key that a cut keeps; both bear on balance alone.
SAMPLED, CUT_BYTES = 20, 200

#: The rules of the registered query.
RULES = [
    (ALLOW, "com/"),
    (BLOCK, "example.com/en/"),
    (ALLOW, "www.example.com/en/"),
    (BLOCK, "net/es/"),
    (BLOCK, "net/fr/"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, rule string")


def with_host_and_path(urls: DataFrame) -> DataFrame:
    """`urls` with `host` and `path` of their column `url`."""
    after = F.coalesce(F.expr("CASE WHEN locate('://', url) > 0 THEN substring(url, locate('://', url) + 3) END"), F.lit(""))
    cut = urls.withColumn("_after", after).withColumn("_host", F.regexp_extract("_after", "^[^/?#]*", 0))
    path = F.regexp_extract(F.expr("substring(_after, char_length(_host) + 1)"), "^[^?#]*", 0)
    return cut.withColumn("host", F.translate("_host", UPPER, LOWER)).withColumn("path", path).drop("_after", "_host")


def canonical_key(labels: Column, path: Column) -> Column:
    """Reversed labels, a slash, which no label has, and the path, as bytes, whose order is that of the sweep."""
    return F.concat(F.concat_ws(".", labels), F.lit("/"), path).cast("binary")


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def rule_intervals(rules: DataFrame) -> DataFrame:
    """(key, depth, rule, verdict), one row for each rule; depth is the number of its host's labels."""
    host = F.translate(F.regexp_extract("rule", "^[^/]*", 0), UPPER, LOWER)
    path = F.expr("substring(rule, char_length(regexp_extract(rule, '^[^/]*', 0)) + 1)")
    known = rules.where("rule IS NOT NULL AND verdict IS NOT NULL").select("verdict", host.alias("host"), path.alias("path"))
    one = known.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    labels = reversed_labels(F.col("host"))
    return one.select(
        canonical_key(labels, F.col("path")).alias("key"),
        F.size(labels).alias("depth"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )


def url_keys(urls: DataFrame, depths: list[int]) -> DataFrame:
    """(key, row): a key for each of `depths` that the host of (row, host, path) has labels for."""
    labels = reversed_labels(F.col("host"))
    wanted = F.array(*[F.lit(d) for d in depths]) if depths else F.array().cast("array<int>")
    levels = F.filter(wanted, lambda d: d <= F.size(labels))
    keyed = urls.select("row", labels.alias("labels"), "path", F.explode(levels).alias("depth"))
    return keyed.select(canonical_key(F.slice("labels", F.lit(1), F.col("depth")), F.col("path")).alias("key"), "row")


def range_cuts(keys: DataFrame, ranges: int) -> list[tuple[bytes, int]]:
    """Where to cut sorted (key, row) into about equal ranges, from some SAMPLED keys for each; `ranges` bounds them."""
    step = max(1, keys.count() // (SAMPLED * ranges))
    cut = F.substring("key", 1, CUT_BYTES).alias("key")
    drawn = keys.where(F.pmod(F.xxhash64("row", "key"), F.lit(step)) == 0).select(cut, "row").collect()
    found = sorted((bytes(r["key"]), r["row"]) for r in drawn)
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def dealt(keys: DataFrame, rules: DataFrame, cuts: list[tuple[bytes, int]]) -> DataFrame:
    """Keys, and every rule for each range that its interval meets, sorted within ranges, rules first."""

    def key_ranges(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at = [bisect_right(cuts, x) for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], ["key", "row", "range"])

    def rule_ranges(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                first, last = bisect_right(cuts, (row["key"], -1)), bisect_right(cuts, (row["key"] + b"\xff", -1))
                copies = [row | {"row": -1, "range": at} for at in range(first, last + 1)]
                yield pa.RecordBatch.from_pylist(copies, rule_schema)

    import pyarrow as pa

    rule_schema = pa.schema(
        [("key", pa.binary()), ("row", pa.int64()), ("range", pa.int32()), ("depth", pa.int32()), ("rule", pa.string()), ("verdict", pa.string())]
    )
    ranged = keys.select("key", "row").mapInArrow(key_ranges, "key binary, row long, range int")
    spread = rules.mapInArrow(rule_ranges, "key binary, row long, range int, depth int, rule string, verdict string")
    both = ranged.unionByName(spread, allowMissingColumns=True)
    return both.repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions("range", "key", "row")


def sweep(sorted_keys: DataFrame) -> DataFrame:
    """(row, depth, rule, verdict) of each key that a rule's interval holds: the longest such rule of that many labels."""

    def swept(batches: Iterator) -> Iterator:
        import pyarrow as pa

        here, stack = None, []
        for batch in batches:
            out = []
            columns = [batch.column(name).to_pylist() for name in ("range", "key", "row", "depth", "rule", "verdict")]
            for at, key, row, depth, rule, verdict in zip(*columns):
                if at != here:
                    here, stack = at, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if rule is not None:
                    stack.append((key, depth, rule, verdict))
                elif stack:
                    out.append((row, *stack[-1][1:]))
            if out:
                kinds = [pa.int64(), pa.int32(), pa.string(), pa.string()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "depth", "rule", "verdict"])

    return sorted_keys.mapInArrow(swept, "row long, depth int, rule string, verdict string")


def judge_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of (page_id, url) by the rules (rule, verdict)."""
    spark = urls.sparkSession
    rows = with_host_and_path(urls.select("page_id", "url")).select(
        F.monotonically_increasing_id().alias("row"), "page_id", "host", "path"
    )
    rows = stored(rows, "urls")  # the numbers of rows have to stay
    intervals = rule_intervals(rules)
    depths = [r["depth"] for r in intervals.select("depth").distinct().collect()]  # at most as many as a host has labels
    keys = url_keys(rows, sorted(depths))
    cuts = range_cuts(keys, int(spark.conf.get("spark.sql.shuffle.partitions")))
    longest = F.max_by(F.struct("rule", "verdict"), F.struct(F.char_length("rule"), "depth"))
    best = sweep(dealt(keys, intervals, cuts)).groupBy("row").agg(longest.alias("best"))
    own = F.when(F.col("host") == "", BLOCK).otherwise(ALLOW)
    return rows.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", own).alias("verdict")
    )


def drop_blocked(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule) of the rows of (page_id, url) that the rules allow."""
    return judge_urls(urls, rules).where(F.col("verdict") == ALLOW).drop("verdict")


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by RULES."""
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


OP12_SQL = f"""
WITH rules AS (
  SELECT unnest({[verdict for verdict, _ in RULES]}) AS verdict, unnest({[rule for _, rule in RULES]}) AS rule
), parsed AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), cut AS (
  SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parsed
), judged AS (
  SELECT rid, rule, verdict FROM cut, rules
  WHERE ('.' || host) LIKE ('%.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, strpos(rule, '/')))
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC) = 1
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
FROM cut LEFT JOIN judged USING (rid)
"""
