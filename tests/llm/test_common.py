import re
from pathlib import Path

import numpy as np
import pytest
from lanemesh.llm import common


def resident():
    return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text()).group(1)) / 1024


@pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="reads Linux's figures")
def test_a_lean_function_leaves_no_free_memory_behind():
    pins = []

    def run(parts):
        held = [np.ones(12_000) for _ in range(2500)]  # 240 MB in blocks that the C library takes from its heap
        pins.extend(held[:-1:100] + held[-1:])  # the last one keeps the heap's end where it is
        for part in parts:
            yield part + len(held)

    before = resident()
    assert list(common.lean(run)([1, 2])) == [2501, 2502]
    assert resident() - before < 100


def test_a_lean_function_ends_early_and_fails_as_without():
    def run(parts):
        for part in parts:
            yield 1 // part

    assert next(common.lean(run)(iter([1, 0]))) == 1
    with pytest.raises(ZeroDivisionError):
        list(common.lean(run)(iter([1, 0])))


@pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="reads Linux's figures")
def test_the_driver_keeps_no_free_native_memory_when_a_table_is_written(spark):
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    taken = lambda: int(re.search(r"RssAnon:\s+(\d+)", Path(f"/proc/{pid}/status").read_text()).group(1)) / 1024
    native = spark._jvm.org.apache.spark.unsafe.Platform
    common.dropped(common.materialized(spark.range(1), "common-test"))
    blocks = [native.allocateMemory(100_000) for _ in range(3000)]  # 300 MB in blocks that the C library takes from its heaps
    for at in blocks:
        native.setMemory(at, 1, 100_000)
    full = taken()
    for at in blocks[:-1]:  # the last one keeps the heap's end where it is
        native.freeMemory(at)
    common.dropped(common.materialized(spark.range(1), "common-test"))
    native.freeMemory(blocks[-1])
    assert taken() < full - 150


def test_a_table_is_written_where_the_driver_has_no_command_to_give_memory_back(spark, monkeypatch):
    def missing(*_):
        raise common.Py4JError("no such operation")

    monkeypatch.setattr(spark.sparkContext._gateway, "new_array", missing)
    out = common.materialized(spark.range(3), "common-test")
    assert out.count() == 3
    common.dropped(out)
