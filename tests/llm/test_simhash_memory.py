"""Variants are made, and met, in little memory; links stay those of all pairs."""

import tracemalloc

import numpy as np
import pandas as pd

from greenledger.llm import simhash_dedup as s


class Tasks:
    """Stands for a table: keeps the functions that would run in tasks."""

    def __init__(self, rows):
        self.rows, self.emit, self.meet = rows, None, None

    def count(self):
        return self.rows

    def repartition(self, *_):
        return self

    def groupBy(self, *_):
        return self

    def mapInPandas(self, f, _):
        self.emit = f
        return self

    def applyInPandas(self, f, _):
        self.meet = f
        return self


def peak_mb(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_task_holds_few_variants():
    rng = np.random.default_rng(3)
    fps = rng.integers(-(2**63), 2**63 - 1, 6000, np.int64)
    fps[3000:] = fps[:3000] ^ rng.choice(np.int64(1) << np.arange(60), 3000)  # a bit apart
    fps = np.unique(fps)
    tasks = s.link_fingerprints(Tasks(len(fps)), 3)
    dealt, top = [], 0.0
    frames = tasks.emit(iter([pd.DataFrame({"fp": fps})]))
    while True:
        frame, mb = peak_mb(lambda: next(frames, None))
        top = max(top, mb)
        if frame is None:
            break
        dealt.append(frame)
    links = set()
    for _, group in pd.concat(dealt).groupby("bucket"):
        found, mb = peak_mb(lambda group=group: tasks.meet(group))
        top = max(top, mb)
        links |= set(zip(found["a"], found["b"], strict=True))
    assert top < 70  # 83 with buckets and turns twice as large
    u = fps.view(np.uint64)
    near = {(i, j) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= 3).tolist() if i != j}
    assert {(int(fps[i]), int(fps[j])) for i, j in near} == links | {(b, a) for a, b in links}
