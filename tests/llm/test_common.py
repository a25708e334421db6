from pathlib import Path

import pyarrow as pa

from txnwatch.llm import common as C


def held_mb() -> float:
    text = Path("/proc/self/smaps_rollup").read_text()
    return int(next(x for x in text.splitlines() if x.startswith("Anonymous:")).split()[1]) / 1024


def test_memory_is_given_back_when_a_task_is_done():
    """Small pieces that stay, as a worker's modules do, keep the C library from giving back what is free between them."""
    stay = []

    def task():
        texts = [bytes([i % 251]) * 2_000 for i in range(100_000)]
        stay.extend(texts[::500])
        held.append(held_mb())
        yield len(texts)

    before, held = held_mb(), []
    for run in (task(), C.then_given_back(task())):
        assert list(run) == [100_000]
        held.append(held_mb())
    most, kept, _, after = held
    assert most - before > 150 and kept - before > 100  # what a task leaves by itself
    assert after - before < 50


def test_texts_one_by_one():
    texts = pa.array(["a", None, "", "ü"] * 300 + ["z"])
    assert list(C.each_bytes(texts, 7)) == C.byte_list(texts)
    assert list(C.each_bytes(texts.slice(5, 3))) == C.byte_list(texts.slice(5, 3))
    assert list(C.each_bytes(pa.array([], pa.string()))) == []
