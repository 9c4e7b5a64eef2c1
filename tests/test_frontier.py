from ledgerloom.operators import discover
from ledgerloom.plans import queries

SF = "/root/testdata/sf0.01"


def test_frontier_reads_the_whole_table(spark, monkeypatch):
    taken = []
    real = discover.frontier

    def spy(links, *rest):
        taken.append(links)
        return real(links, *rest)

    monkeypatch.setattr(discover, "frontier", spy)
    got = {(r["node"], r["depth"]) for r in queries.QUERIES["frontier"](spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_partkey", "l_linenumber").collect()
    assert taken[0].count() == len(table)
    near = {}
    for part, line in table:
        near.setdefault(part, set()).add((part * 7 + line) % 500)
    depth, edge = {1: 0}, {1}
    for d in (1, 2, 3):
        edge = {y for x in edge for y in near.get(x, ())} - depth.keys()
        depth |= dict.fromkeys(edge, d)
    assert got == set(depth.items())
