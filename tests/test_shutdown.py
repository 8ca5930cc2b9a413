"""A stream that is told to end by a signal lets its batch end and goes on later."""

import os
import signal
import subprocess
import sys
import time

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHILD = """
import sys, time
sys.path.insert(0, {repo!r})
from ratewise.session import build_session
from ratewise.streaming import start, stop_on_signal
spark = build_session("local[1]", 1)
base = {base!r}
src = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(base + "/in")

def fn(batch, batch_id):
    open(base + "/began", "w").close()
    time.sleep(3)
    batch.write.mode("overwrite").parquet(base + "/out/b" + str(batch_id))

q = start(src, fn, base + "/ckpt", processing_time="0 seconds")
stop_on_signal(q)
q.awaitTermination()
print("ended")
"""


def test_signal_lets_the_batch_end(spark, tmp_path):
    base = str(tmp_path)
    for i in range(3):
        spark.createDataFrame([(str(i),)], "value string").coalesce(1).write.mode("append").parquet(base + "/in")
    child = subprocess.Popen([sys.executable, "-c", CHILD.format(repo=REPO, base=base)], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True)
    try:
        until = time.time() + 90
        while not os.path.exists(base + "/began") and time.time() < until:
            time.sleep(0.1)
        child.send_signal(signal.SIGTERM)           # in the middle of batch 0
        out, _ = child.communicate(timeout=90)
    finally:
        child.kill()
    assert "ended" in out and child.returncode == 0
    done = sorted(n for n in os.listdir(base + "/ckpt/commits") if n.isdigit())
    assert done[:1] == ["0"] and len(done) < 3       # the batch that ran has ended, the rest has not been drained
    assert all(os.path.exists(f"{base}/out/b{n}/_SUCCESS") for n in done)

    # another process goes on behind it: every message once
    from ratewise.streaming import start
    src = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(base + "/in")
    start(src, lambda b, i: b.write.mode("overwrite").parquet(f"{base}/out/b{i}"), base + "/ckpt", available_now=True).awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(base + "/out/*").collect()) == ["0", "1", "2"]
