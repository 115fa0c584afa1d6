"""Published leaderboard values: the rate rules reproduce them exactly."""
from pyspark.sql import functions as F

from crease.functions import rate

# FIXED VALUES: the committed season leaderboards (20 matches).
BATTERS = [("SA Yadav", 177, 130, 9, 12, 136.15), ("CH Gayle", 172, 91, 9, 17, 189.01),
           ("Yuvraj Singh", 166, 110, 12, 13, 150.91), ("V Kohli", 165, 119, 18, 5, 138.66),
           ("S Dhawan", 143, 117, 11, 6, 122.22), ("ML Hayden", 129, 93, 16, 3, 138.71),
           ("Ishan Kishan", 123, 75, 11, 6, 164.0), ("F du Plessis", 119, 98, 13, 1, 121.43),
           ("Abhishek Sharma", 115, 75, 11, 7, 153.33), ("Tilak Varma", 110, 91, 7, 5, 120.88)]
BOWLERS = [("K Rabada", 161, 127, 7.61, 6), ("RA Jadeja", 106, 75, 8.48, 6),
           ("M Muralitharan", 110, 77, 8.57, 5), ("AR Patel", 90, 61, 8.85, 4),
           ("I Sharma", 102, 80, 7.65, 4), ("R Ashwin", 138, 116, 7.14, 4),
           ("TA Boult", 127, 94, 8.11, 4), ("B Kumar", 111, 74, 9.0, 3),
           ("HV Patel", 102, 74, 8.27, 3), ("JD Unadkat", 135, 77, 10.52, 3)]


def test_strike_rates(spark):
    df = spark.createDataFrame([b[:3] for b in BATTERS], "batter string, runs long, balls long")
    got = dict(df.select("batter", rate("runs", "balls", 100, 2)).collect())
    assert got == {b[0]: b[5] for b in BATTERS}


def test_economy_and_tie_order(spark):
    df = spark.createDataFrame([(b[0], b[1], b[2], b[4]) for b in BOWLERS],
                               "bowler string, runs long, balls long, wickets long")
    got = df.select("bowler", rate("runs", "balls", 6, 2).alias("e"), "wickets")
    assert dict((r.bowler, r.e) for r in got.collect()) == {b[0]: b[3] for b in BOWLERS}
    order = [r.bowler for r in got.orderBy(F.col("wickets").desc(), F.col("bowler")).collect()]
    assert order == [b[0] for b in BOWLERS]
    assert min(b[2] for b in BOWLERS) >= 60
