"""Tables written on the way belong to the call that wrote them."""

import threading

import pytest

pytest.importorskip("tickerloom.llm")

from tickerloom.llm.tables import on_the_way, release, saved  # noqa: E402


def test_release_takes_only_the_tables_of_its_call(spark):
    before = saved(spark.range(3), "t")
    others = {}

    def other():
        with on_the_way() as paths:
            others["df"], others["paths"] = saved(spark.range(4), "t"), list(paths)

    with on_the_way() as paths:
        first = saved(spark.range(5), "t")
        thread = threading.Thread(target=other)
        thread.start()
        thread.join()
        with on_the_way() as inner:
            nested = saved(spark.range(6), "t")
            assert len(inner) == 1
        kept = saved(first.where("id > 1"), "t")
        release(spark, paths, kept)
        assert len(paths) == 1
    assert before.count() == 3 and others["df"].count() == 4 and len(others["paths"]) == 1 and nested.count() == 6 and kept.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        first.count()
