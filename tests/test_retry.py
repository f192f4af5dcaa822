"""Task failures: a write whose task fails on its first attempt is retried and counted exactly once."""
import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent('''
    import sys
    sys.path.insert(0, {repo!r})
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from stratum.session import local_session
    from stratum.sources.tables import TableStore
    from stratum.sources import standin

    # local[4, 3]: a failed task is retried up to 3 times; small Arrow batches so the fault hits mid-partition
    spark = local_session("retry", cores="4, 3", conf={{"spark.sql.execution.arrow.maxRecordsPerBatch": "100"}})

    def flaky(batches):
        # fault injection for the test only: the first attempt of partition 0 dies halfway through its rows
        ctx = TaskContext.get()
        for i, pdf in enumerate(batches):
            if ctx.partitionId() == 0 and ctx.attemptNumber() == 0 and i > 0:
                raise RuntimeError("injected task failure")
            yield pdf

    items = standin.order_items(standin.Tables(spark, {sf!r}))
    expected = items.count()
    flaky_items = items.repartition(4).mapInPandas(flaky, items.schema)
    store = TableStore("file://" + {root!r})
    written = store.write(flaky_items, "silver", "order_items")
    print("RESULT", expected, written, store.read(spark, "silver", "order_items").count())
''')


def test_write_survives_a_failed_task_attempt(tmp_root):
    script = SCRIPT.format(repo=REPO, sf="/root/testdata/sf0.001", root=f"{tmp_root}/lake")
    env = dict(os.environ, PYSPARK_PYTHON=sys.executable)
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600, env=env)
    line = next((x for x in out.stdout.splitlines() if x.startswith("RESULT")), None)
    assert line, out.stderr[-3000:]
    expected, written, read_back = map(int, line.split()[1:])
    assert written == expected == read_back                     # no lost or doubled rows, observed count exact
    assert "injected task failure" in out.stderr                # the first attempt did fail
