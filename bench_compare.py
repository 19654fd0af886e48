"""

Same settings as bench.py; medians of warm runs. The folds run on COPIES (default 40) times the
feed, a third of it in its 1,500 keys and the rest in about two million.
"""

from __future__ import annotations

import os
import statistics
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from changefold.functions.decode import CLEAN_SCHEMA, LINEAGE_SCHEMA, REPAIRED_PAYLOAD_SCHEMA, clean_projection
from changefold.functions.quality import REPAIRED_RULES, expect_all_or_drop
from changefold.operators.apply_changes import cut_truncated, fold, mark, present, to_state
from changefold.operators.delivery import triage
from changefold.plans.feed import change_feed
from changefold.session import local_session, work_dir
from changefold.streaming.refresh import HISTORY, PRODUCTS
from changefold.streaming.target import Target, declare, merge_batch, read_target


#: Buckets of a target here.
BUCKETS = 16


def discard(frame):
    frame.write.format("noop").mode("overwrite").save()


def median(label, run, rows=None, times=5):
    run()
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    middle = statistics.median(taken)
    print(f"{label:58s} {middle:8.3f} s" + (f"  {rows / middle:12,.0f} rows/s" if rows else ""), flush=True)


def plain_projection(bronze):
    """The clean projection without the step that keeps the parse in one place."""
    parsed = bronze.select("topic", "partition", "offset", F.from_json("payload", REPAIRED_PAYLOAD_SCHEMA).alias("p"))
    return parsed.selectExpr(
        "coalesce(p.after.product_id, p.before.product_id) AS product_id",
        "p.after.product_name",
        "p.after.product_type",
        "p.after.description",
        "try_to_timestamp(p.after.created_at) AS created_at",
        "try_to_timestamp(p.after.updated_at) AS updated_at",
        "p.op",
        "p.source.ts_ms",
        "topic",
        "partition",
        "offset",
    )


def current_by_max_by(changes):
    marked = mark(changes, PRODUCTS)
    rest = [c for c in marked.columns if c != "product_id"]
    newest = marked.groupBy("product_id").agg(F.max_by(F.struct(*rest), F.struct("ts_ms", "offset", "partition")).alias("row"))
    folded = newest.select("product_id", *[F.col(f"row.{c}") for c in rest])
    return present(cut_truncated(folded, marked, PRODUCTS), PRODUCTS)


def history_by_two_shuffles(changes):
    """Versions first, bounds second, for every key."""
    in_key = Window.partitionBy("product_id").orderBy("ts_ms")
    return fold(mark(changes, HISTORY), HISTORY).withColumn("valid_to", F.lead("ts_ms").over(in_key))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    root = work_dir(spark, "compare")
    triage(change_feed(spark, sf_dir))[0].select("schema", "payload", "topic", "partition", "offset").write.parquet(f"{root}/bronze")
    bronze = spark.read.parquet(f"{root}/bronze")
    rows = bronze.count()

    def persisted():
        kept = plain_projection(bronze).persist()
        discard(expect_all_or_drop(kept, REPAIRED_RULES))
        kept.unpersist()

    median("clean: parse kept in one place", lambda: discard(expect_all_or_drop(clean_projection(bronze, "repaired"), REPAIRED_RULES)), rows)
    median("clean: filter after persist()", persisted, rows)
    median("clean: plain chain", lambda: discard(expect_all_or_drop(plain_projection(bronze), REPAIRED_RULES)), rows)

    expect_all_or_drop(clean_projection(bronze, "repaired"), REPAIRED_RULES).write.parquet(f"{root}/clean")
    clean = spark.read.schema(f"{CLEAN_SCHEMA}, {LINEAGE_SCHEMA}").parquet(f"{root}/clean")
    rows = clean.count()
    copies = int(os.environ.get("COPIES", "40"))
    grown = clean.crossJoin(spark.range(copies).withColumnRenamed("id", "copy")).withColumns(
        {
            "product_id": F.expr("concat(product_id, CASE WHEN copy % 3 = 0 THEN '' ELSE concat('-', copy, '-', offset % 500) END)"),
            "ts_ms": F.expr("ts_ms + copy * 1000"),
            "offset": F.expr("offset * 100 + copy"),
        }
    )
    grown.drop("copy").write.parquet(f"{root}/grown")
    grown, many = spark.read.parquet(f"{root}/grown"), rows * copies
    median("current state: ranked", lambda: discard(present(to_state(mark(grown, PRODUCTS), PRODUCTS), PRODUCTS)), many, 3)
    median("current state: max_by", lambda: discard(current_by_max_by(grown)), many, 3)
    median("history", lambda: discard(present(to_state(mark(grown, HISTORY), HISTORY), HISTORY)), many, 3)
    median("history: two shuffles for every key", lambda: discard(history_by_two_shuffles(grown)), many, 3)

    for name, spec in (("current state", PRODUCTS), ("history", HISTORY)):
        for batches in map(int, os.environ.get("BATCHES", "1,10,100").split(",")):
            dealt = F.pmod(F.xxhash64("offset"), F.lit(batches))
            grown.withColumn("batch", dealt).write.partitionBy("batch").parquet(f"{root}/batches-{name[:7]}-{batches}")
            path = f"{root}/{name.replace(' ', '_')}_{batches}"
            target = Target(f"default.compare_{name.replace(' ', '_')}_{batches}", path, spec, f"{CLEAN_SCHEMA}, {LINEAGE_SCHEMA}", BUCKETS)
            declare(spark, target)
            taken = []
            for batch_id in range(batches):
                start = time.perf_counter()
                merge_batch(spark.read.schema(grown.schema).parquet(f"{root}/batches-{name[:7]}-{batches}/batch={batch_id}"), batch_id, target)
                taken.append(time.perf_counter() - start)
            middle = statistics.median(taken)
            print(f"{name}, {many // batches:,} changes in each of {batches}: {sum(taken):.1f} s, batch {middle:.2f} s, last {taken[-1]:.2f} s", flush=True)
            median(f"{name}, read after {batches}", lambda: discard(read_target(spark, target)), times=3)


if __name__ == "__main__":
    main()
