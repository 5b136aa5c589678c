"""The closure of a vocabulary: what its rounds write."""

from pyspark.sql import functions as F

from massloom.session import durable
from massloom.sources import vocabulary


def test_each_way_is_written_once(spark, monkeypatch):
    """chains, shortcuts and a circle; no round writes again what is known."""
    edges = [(f"t{k}", f"t{k - 1}") for k in range(1, 21)] + [("t20", "t9"), ("t15", "t3"), ("t0", "t4"), ("u", "v"), ("v", "u"), ("x", None)]
    terms = spark.createDataFrame(edges, "accession string, parent string").groupBy("accession").agg(F.collect_list("parent").alias("is_a"))
    written = []
    monkeypatch.setattr(vocabulary, "durable", lambda df, label: written.append(durable(df, label)) or written[-1])
    gone = []
    monkeypatch.setattr(vocabulary, "forget", lambda table: gone.append(table))
    found = {(r["accession"], r["ancestor"]): r["distance"] for r in vocabulary.ancestors(terms).collect()}
    steps = {}
    for a, b in edges:
        if b:
            steps.setdefault(a, set()).add(b)
    known = {}
    for start in steps:
        at, n = {start}, 0
        while at:
            n += 1
            at = {b for a in at for b in steps.get(a, ()) if (start, b) not in known}
            known |= {(start, b): n for b in at}
    assert found == known
    assert sum(t.count() for t in written) == len(known)
