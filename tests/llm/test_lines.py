import pytest
from pyspark.sql import functions as F

from lectern.llm import lines

SPACE = " \t\n\x0b\x0c\r"
UPPER = {ord(c): chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, least_chars=40, least_docs=5):
    """(id, n_lines, n_dropped, kept) by one dictionary of all lines; a null id comes before all others."""
    own = lambda i: -(1 << 63) if i is None else i
    key = lambda line: line.strip(SPACE).translate(UPPER)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(own(i))
    out = []
    for i, text in rows:
        all_ = (text or "").split("\n")
        kept = [x for x in all_ if len(holders.get(key(x), ())) < least_docs or max(holders[key(x)]) == own(i)]
        out.append((i, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


LONG = "A line that many documents share, long enough to count"


def corpus():
    rows = [(i, f"{'  ' if i % 2 else ''}{LONG if i % 3 else LONG.lower()}\t\nown line {i}\n{LONG}") for i in range(40)]
    rows += [(100 + i, "é" * 40 + "\n" + "É" * 40 + "\nshort") for i in range(4)]  # É isn't lower-cased; four documents only
    rows += [(200 + i, "x" * 39 + "\n\n\n" + "y" * 40) for i in range(6)]
    rows += [(300, "z" * 50), (300, "z" * 50), (300, "other\n" + "z" * 50), (301, "z" * 50), (302, "z" * 50), (303, "z" * 50)]  # four documents
    rows += [(None, LONG), (None, LONG + "\nmore"), (400, None), (401, ""), (402, "\n"), (403, LONG + "\n" + LONG)]
    rows += [(500 + i, "\n".join(f"line {j} of a block that is shared by some documents only" for j in range(i * 7))) for i in range(12)]
    return rows


@pytest.mark.parametrize("batches, fanout", [(8, 3), (1, 2), (5, 2)])
def test_like_brute_force(spark, batches, fanout):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = lines.dedup_lines(docs, batches=batches, fanout=fanout).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_edges(spark, edges, edge_rows):
    found = lines.dedup_lines(edges, least_docs=2).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute([r[:2] for r in edge_rows], least_docs=2)
    assert lines.dedup_lines(edges.limit(0)).count() == 0


def test_batches_meet_the_runs_without_moving_them(spark):
    runs = lines.LineRuns(spark, 4, 2)
    made = spark.range(1000).select("id", F.lit(1).alias("h2"))
    for low, high in ((500, 1000), (300, 700), (0, 600), (0, 1000), (900, 1000)):
        runs.add(lines.key_counts(made.where(f"id >= {low} and id < {high}").select((F.col("id") * -1).alias("doc"), F.col("id").alias("h1"), "h2")))
    assert [len(level) for level in runs.levels] == [1, 0, 1]  # five runs, compacted by twos
    kept = [spark.table(name) for name, _ in runs.runs()]
    assert sorted(t.count() for t in kept) == [0, 1000]  # each key in one run
    joined = kept[0].join(kept[1].hint("merge"), ["h1", "h2"], "left_anti")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    ranges = ((500, 1000), (300, 700), (0, 600), (0, 1000), (900, 1000))
    assert {r.h1: r.last for r in runs.totals(4).collect()} == {i: -i for i in range(1000) if sum(a <= i < b for a, b in ranges) >= 4}
