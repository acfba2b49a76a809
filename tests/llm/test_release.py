"""What ``release`` gives back."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from freshet.llm import common


def test_memory_freed_outside_the_heap_goes_back(spark):
    if not common.give_back(spark):
        pytest.skip("this JVM has no command for it")
    jvm = spark.sparkContext._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()

    def held() -> float:
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text()))) / 1024

    taken = [jvm.java.util.zip.Deflater() for _ in range(800)]  # some 260 kB each outside the heap
    for d in taken:
        d.setInput(bytearray(b"text"))
        d.finish()
    for _ in range(3):
        jvm.System.gc()
    for d in taken[::2]:  # every other one, so the C library can't shrink its arenas by itself
        d.end()
    full = held()
    common.release(spark)
    left = held()
    for d in taken[1::2]:
        d.end()
    assert full - left > 20
