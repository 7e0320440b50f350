"""What Python workers keep between tasks, and how new units of a text are found."""

import re

from greenledger.llm.common import giving_back


def held_mb() -> float:
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Pss_Anon:\s+(\d+)", f.read())[1]) / 1024


def test_a_task_gives_back_what_it_freed():
    def work(batches):
        for n in batches:
            kept = [bytes(1000) for _ in range(n)]
            last = [bytes(1000)]  # stands above the freed ones, so they stay with the process by themselves
            del kept
            yield last

    before = held_mb()
    out = list(giving_back(work)([150_000]))
    assert held_mb() - before < 50
    assert len(out) == 1


def test_all_long_lived_workers_give_back():
    import inspect

    from greenledger.llm import packing, simhash_dedup, suffix_dedup, toxicity

    for module in (packing, simhash_dedup, suffix_dedup, toxicity):
        calls = re.findall(r"mapIn(?:Arrow|Pandas)\(\s*(\w+)", inspect.getsource(module))
        assert calls and set(calls) == {"giving_back"}, (module.__name__, calls)
