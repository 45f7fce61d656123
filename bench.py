"""Times the headline queries on the tables in $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from checks import queries, shapes
from threadloom.plans import comments as pc
from threadloom.plans import posts as pp
from threadloom.plans import users as pu
from threadloom.schemas import COMMENTS, POSTS, USERS
from threadloom.session import local_session, work_folder
from threadloom.sources import dump

REGISTERED = [
    "posts_features", "users_processed", "comments_processed", "text_stats", "topic_class", "html_strip",
    "dead_letter_summary", "upsert_latest", "split_tables", "upsert_posts", "stream_append_comments",
]
TABLES = ["documents", "customer", "conversations", "pages", "events"]
CORES = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = 2


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(run) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def in_files(spark, sf: str) -> str:
    """The tables in as many files as there are cores, as tables lie on a cluster; here each is one row group."""
    folder = work_folder(spark, "bench-tables")
    for name in TABLES:
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(CORES).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    given = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(CORES, app="bench")
    sf = in_files(spark, given)
    seconds, rows = {}, {}

    # Dump file to finished rows, as in a first load.
    for name, shape, columns, transform in [
        ("posts_from_dump", shapes.posts, POSTS, pp.posts_features),
        ("users_from_dump", shapes.users, USERS, pu.users_processed),
        ("comments_from_dump", shapes.comments, COMMENTS, pc.comments_processed),
    ]:
        path = queries.written_dump(spark, shape(spark, sf), name)
        rows[name] = spark.read.text(path).count()
        seconds[name] = best_of(lambda: consume(transform(dump.scan_dump(spark, path, columns))))

    for name in REGISTERED:
        seconds[name] = best_of(lambda: consume(queries.QUERIES[name](spark, sf)))

    scale = re.search(r"sf([\d.]+)", given)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale[1]) if scale else given,
        "rows_per_sec": {n: round(rows[n] / seconds[n]) for n in rows}}))
    spark.stop()


if __name__ == "__main__":
    main()
