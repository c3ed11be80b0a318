"""Means of tracts that lie halfway between two rounded ones."""

from strandwise.operators.tracts import tract_evidence


def test_means_are_added_up_by_place(spark):
    # by place these four come to just under 1.125, and its quarter to less than a half of the fourth place more
    values = [(1, 1 / 3), (2, 2 / 3), (3, 0.1), (4, 0.025)]
    s, c = 0.0, []
    for _, v in values:
        s += v
    want = int(s / 4 * 1e4 + 0.5) / 1e4
    tracts = spark.createDataFrame([("l", 1, 4)], "locus string, start long, `end` long")
    for order in (values, values[::-1], values[2:] + values[:2]):
        sites = spark.createDataFrame([("l", p, 9, v) for p, v in order], "locus string, pos long, depth long, donor_af double").coalesce(1)
        c.append(tract_evidence(tracts, sites, spark.createDataFrame([], "locus string, read string, pos long, call string"), ["locus"]).first()["donor_af_in"])
    assert c == [want] * 3


def test_the_double_is_rounded(spark):
    # 0.48125 is written with a 5 in the fifth place, but the double times 10,000 lies at 4812.5 exactly or not at all
    for v in (0.48125, 0.51875, 0.00005, 1.00005 / 2):
        tracts = spark.createDataFrame([("l", 1, 4)], "locus string, start long, `end` long")
        sites = spark.createDataFrame([("l", 1, 9, v)], "locus string, pos long, depth long, donor_af double")
        got = tract_evidence(tracts, sites, spark.createDataFrame([], "locus string, read string, pos long, call string"), ["locus"]).first()["donor_af_in"]
        assert got == int(v * 1e4 + 0.5) / 1e4
