"""Generated targets and batches: the daily-guarded upsert against a plain Python model."""

import random

from ratewise.operators.upsert import apply_actions, classify

TODAY = "2024-01-31"
DAYS = ["2024-01-29", "2024-01-30", TODAY]


def model(target, incoming):
    latest = {}
    for u, _, d in target:
        latest[u] = max(latest.get(u, d), d)
    actions = {u: ("insert" if u not in latest else "update" if latest[u] != TODAY else "skip")
               for u, _ in incoming}
    written = {u: r for u, r in incoming if actions[u] != "skip"}
    after = [row for row in target if row[0] not in written] + [(u, r, TODAY) for u, r in written.items()]
    return actions, sorted(after)


def test_upsert_matches_model(spark):
    rnd = random.Random(5)
    target = [(rnd.randrange(300), f"r{i}", rnd.choice(DAYS)) for i in range(1500)]   # users repeat
    incoming = [(u, f"n{u}") for u in rnd.sample(range(400), 250)]
    t = spark.createDataFrame(target, "user_id int, res string, day string")
    i = spark.createDataFrame(incoming, "user_id int, res string")
    acts = classify(i, t, TODAY)
    want_actions, want_after = model(target, incoming)
    assert {r.user_id: r.action for r in acts.collect()} == want_actions
    assert sorted(tuple(r) for r in apply_actions(t, acts).collect()) == want_after
    assert set(want_actions.values()) == {"insert", "update", "skip"}
