import os

from ledgerlark.session import materialise, scratch_scope, shared_folder


def test_a_scope_drops_what_was_written_in_it(spark):
    def tables():
        return {n for n in os.listdir(shared_folder(spark)) if n.startswith(("inner", "kept", "outer"))}

    before = tables()
    with scratch_scope(spark):
        outer = materialise(spark.range(3), "outer")
        with scratch_scope(spark):
            inner = materialise(outer.selectExpr("id + 1 AS id"), "inner")
            kept = materialise(inner.selectExpr("id * 2 AS id"), "kept", keep=True)
            assert len(tables() - before) == 3
        assert {n.split("-")[0] for n in tables() - before} == {"outer", "kept"}
        assert sorted(r["id"] for r in kept.collect()) == [2, 4, 6]
    assert tables() == before


def test_a_scope_ends_with_an_error_too(spark):
    before = set(os.listdir(shared_folder(spark)))
    try:
        with scratch_scope(spark):
            materialise(spark.range(1), "inner")
            raise KeyError
    except KeyError:
        pass
    assert set(os.listdir(shared_folder(spark))) == before
    materialise(spark.range(1), "free")
    assert len(os.listdir(shared_folder(spark))) == len(before) + 1
