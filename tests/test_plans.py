"""Properties of the physical plans that hold at any scale."""

import os
import re

import pytest

from tidemark.catalogue import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [n for n in QUERIES if not n.startswith(("k1", "k2", "s8", "r1_compacted", "m1", "m3", "stream", "f11", "f2_counts", "f3_screened", "f3_found", "f6_copied", "drain_", "backfill_", "k4_w", "f5_pages_text", "f5_pages_p"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert word not in text, f"{name}: {word}"


# The only sums over a whole frame are those of the slot totals, one row per slot.
WHOLE_FRAME = {"f5_pages", "f5_pages_ties", "f5_pages_time", "f5_pages_decimal"}


@pytest.mark.parametrize("name", LAZY)
def test_windows_have_keys(spark, sf, name):
    bare = re.findall(r"Window \[[^\n]*?\], \[[^\]]*(?:ASC|DESC)[^\]]*\]\n", plan(QUERIES[name](spark, sf)))
    bare = [w for w in bare if w.count("], [") == 1]
    assert len(bare) <= (1 if name in WHOLE_FRAME else 0), bare


def test_page_condition_reaches_the_scan(spark, sf):
    text = plan(QUERIES["f4_page"](spark, sf))
    assert "LessThan(o_orderkey,1000)" in text and "TakeOrderedAndProject" in text
    assert "o_comment" not in text and "o_orderdate" not in text


def test_latest_state_reduces_before_the_shuffle(spark, sf):
    text = plan(QUERIES["r3_snapshot_merge"](spark, sf))
    assert text.count("Exchange") == 1
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_numbering_shuffles_by_slot(spark, sf):
    text = plan(QUERIES["b1_batches"](spark, sf))
    rows = text[:text.index("BroadcastExchange")] if "BroadcastExchange" in text else text
    assert re.search(r"Exchange hashpartitioning\(source_table#\d+, _slot#\d+L", rows)
    assert "SinglePartition" not in text


def test_times_are_laid_out_without_a_scratch_copy(spark, sf):
    text = plan(QUERIES["f5_pages_time"](spark, sf))
    assert "rangepartitioning" not in text and "ranged-" not in text and "_slot" in text


def test_key_profiles_multiply_no_rows(spark, sf):
    assert "Expand" not in plan(QUERIES["f3_key_profile"](spark, sf))


def test_tables_are_dealt_by_range(spark, sf):
    from tidemark.catalogue.tables import feed
    from tidemark.operators.batches import partition_by_table
    assert "rangepartitioning(source_table" in plan(partition_by_table(feed(spark, sf)))


def test_remap_prunes_the_scan(spark, sf):
    assert "p_size" not in plan(QUERIES["t4_remap"](spark, sf))


def test_range_slots_read_a_checkpoint(spark, sf):
    text = plan(QUERIES["f5_pages_text"](spark, sf))
    assert "Scan ExistingRDD" in text and "rangepartitioning" not in text


def test_no_local_checkpoint_or_collect_in_the_library():
    for folder, _, files in os.walk(os.path.join(ROOT, "tidemark")):
        for file in files if os.path.basename(folder) != "llm" else ():
            if file.endswith(".py"):
                text = open(os.path.join(folder, file), encoding="utf-8").read()
                for word in (".localCheckpoint(", ".collect()", ".toPandas(", ".rdd", "crossJoin"):
                    assert word not in text, f"{file}: {word}"
                assert "broadcast(" not in text, file
