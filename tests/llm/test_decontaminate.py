"""Near places of benchmark windows against a search of every place."""

import math
import random

from regstar.llm.decontaminate import SLOP, WINDOW_WORDS, op9_benchmark_decontamination, op9_near_items


def plain(text, items):
    """(items that occur, other items that nearly occur)"""
    w, exact, near = text.split(), set(), set()
    for item, phrase in items:
        p = phrase.split()
        for at in range(max(len(p) - WINDOW_WORDS, 0) + 1):
            win = p[at:at + WINDOW_WORDS]
            if any(w[s:s + len(win)] == win for s in range(len(w))):
                exact.add(str(item))
                continue
            for s in range(-len(win), len(w) + len(win)):
                n = sum(x in w[max(s + i - SLOP, 0):max(s + i + SLOP + 1, 0)] for i, x in enumerate(win))
                if n >= math.ceil(len(win) * 8 / 10):
                    near.add(str(item))
    return sorted(exact), sorted(near - exact)


def test_near_items_equal_a_search_of_every_place(spark, tmp_path):
    rng = random.Random(9)
    own = lambda n: [f"w{min(int(rng.expovariate(0.02)), 400)}" for _ in range(n)]
    items = [(i, " ".join(own(rng.choice([3, 8, 10, 14])))) for i in range(30)]
    items[0] = (0, "alpha beta gamma delta epsilon zeta eta theta iota kappa")
    rows = ["x alpha beta gamma delta epsilon zeta eta theta iota kapa y",  # the rarest word is misspelt; no document has it
            "alpha beta gamma delta new new new epsilon zeta eta theta iota kappa", "alpha beta gamma delta epsilon zeta"]
    for _ in range(150):
        p = rng.choice(items)[1].split()
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(p))
            p[k:k + 1] = rng.choice([[], ["odd"], [p[k], "odd"], own(1)])
            p = p or ["odd"]
        rows.append(" ".join(own(20) + p + own(20)))
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in op9_benchmark_decontamination(spark, str(tmp_path)).collect()}
    near_of = {r.doc_id: r for r in op9_near_items(spark, str(tmp_path)).collect()}
    for i, t in enumerate(rows):
        exact, near = plain(t, items)
        assert (got[i].n_items, near_of[i].n_near, near_of[i].near_items) == (len(exact), len(near), ",".join(near)), (i, t)
    assert [near_of[i].near_items for i in range(3)] == ["0", "0", ""]
