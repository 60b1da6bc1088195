"""Messages per second of the whole job, and the share of sealing in it: ``python -m checks.throughput``.

Environment as in `bench.py`. The first run of each job warms the JVM and is not counted.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks import catalog
from checks import fixtures as fx
from formweave.operators import deid, parse, rules
from formweave.plans.ingest import stage
from formweave.session import build_session, spread
from formweave.sources.messages import messages


def _seconds(run, times: int = 3) -> float:
    taken = []
    for _ in range(times + 1):
        started = time.perf_counter()
        run()
        taken.append(time.perf_counter() - started)
    return statistics.median(taken[1:])


def _noop(rows) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("throughput", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    topic = catalog._topic(spark, sf_dir, 8)
    count = messages(spark, topic).count()
    cipher, by_form = fx.cipher(spark), rules.rules_by_form(fx.rules(spark, sf_dir))

    def batch() -> None:
        job = catalog._pipeline(spark, sf_dir, topic)
        job.process(messages(spark, topic), 0)

    def stream() -> None:
        catalog._pipeline(spark, sf_dir, topic).start(available_now=True).awaitTermination()

    opened = parse.read_forms(parse.open_messages(spread(messages(spark, topic)), cipher))
    seconds = {
        "batch_ingest": _seconds(batch), "stream_ingest": _seconds(stream),
        "stage_only": _seconds(lambda: _noop(stage(spread(messages(spark, topic)), fx.rules(spark, sf_dir), cipher,
                                                   fx.BASE_URL, fx.BUCKET))),
        "open_and_parse": _seconds(lambda: _noop(opened)),
        "open_parse_and_seal": _seconds(lambda: _noop(deid.deidentify(opened, by_form, cipher))),
    }
    print(json.dumps({"messages": count, "cores": int(cpus),
                      "seconds": {k: round(v, 3) for k, v in seconds.items()},
                      "messages_per_second": {k: round(count / v) for k, v in seconds.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()
