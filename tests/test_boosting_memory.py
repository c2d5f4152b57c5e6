from test_foldtrees import table

from ledgerlark.operators import boosting


def test_tasks_read_few_blocks_whatever_the_table(spark, monkeypatch):
    df, p, seen = table(spark), boosting.BoostingParams(12, .3, 3, seed=5), []
    want = boosting.boost(df, ["x", "z"], "y", p, "id", None, "fold", 3)
    files, own = [], boosting._blocks
    monkeypatch.setattr(boosting, "TASK_ROWS", 60)
    monkeypatch.setattr(boosting, "_blocks", lambda *a: files.append(own(*a)) or files[-1])
    of_block = boosting.settings
    monkeypatch.setattr(boosting, "settings", lambda spark, conf: seen.append(int(conf["spark.sql.execution.arrow.maxRecordsPerBatch"])) or of_block(spark, conf))
    got = boosting.boost(df, ["x", "z"], "y", p, "id", None, "fold", 3)
    assert len(files[0].inputFiles()) == 15 and len(seen) > 12 and max(seen) <= 8
    a, b = ({r["id"]: r["score"] for r in m.score(df, fold="fold").collect()} for m in (want, got))
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-9
