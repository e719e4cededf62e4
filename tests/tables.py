"""A small linkage case: six reference records, eleven candidates, known matches."""

from twinfold.sources.entities import ENTITY, PAIR

# Records, known matches and the scores of the golden pairs.
S1 = [
    ("s1_001", "acme technologies private limited", "123 main street delhi"),
    ("s1_002", "global trading company", "45 park road mumbai"),
    ("s1_003", "alpha software limited", "10 lake road bangalore"),
    ("s1_004", "north star industries", "77 market street delhi"),
    ("s1_005", "sunrise exports private limited", "9 station road pune"),
    ("s1_006", "delta manufacturing", "88 industrial area chennai"),
]
S2 = [
    ("s2_001", "acme technologies pvt ltd", "123 main st delhi"),
    ("s2_002", "global trading company", "45 park road mumbai"),
    ("s2_003", "alpha software ltd", "10 lake rd bangalore"),
    ("s2_004", "north star industries", "77 market street delhi"),
    ("s2_005", "sunrise exports pvt ltd", "9 station road pune"),
    ("s2_006", "delta manufacturing", "88 industrial area chennai"),
    ("s2_007", "completely different company", "999 unknown road kolkata"),
    ("s2_008", "random business services", "12 random avenue hyderabad"),
]
S3 = [
    ("s3_001", "Acme Tech", "123 Main Street Delhi"),
    ("s3_002", "Global Trading Co", "45 Park Rd Mumbai"),
    ("s3_003", "Unrelated Business", "500 Unknown Road Jaipur"),
]
TRUTH = [
    ("s1_001", "s2_001,s3_001"),
    ("s1_002", "s2_002,s3_002"),
    ("s1_003", "s2_003"),
    ("s1_004", "s2_004"),
    ("s1_005", "s2_005"),
    ("s1_006", "s2_006"),
]

# name and address: ratio, partial, token sort, token set
GOLDEN = {
    "001 s2_001": (86.2069, 86.3636, 86.2069, 86.2069, 89.4737, 80.0000, 89.4737, 90.3226),
    "001 s2_007": (39.3443, 43.1373, 36.0656, 36.0656, 26.6667, 29.2683, 22.2222, 22.2222),
    "001 s3_001": (33.3333, 77.7778, 33.3333, 33.3333, 85.7143, 85.7143, 85.7143, 85.7143),
    "002 s2_002": (100, 100, 100, 100, 100, 100, 100, 100),
    "002 s2_008": (30.4348, 35.7143, 26.0870, 26.0870, 35.5556, 40.0000, 35.5556, 35.5556),
    "002 s3_002": (71.7949, 82.3529, 71.7949, 71.7949, 77.7778, 70.5882, 77.7778, 77.7778),
    "003 s2_003": (90.0000, 94.1176, 90.0000, 90.0000, 95.2381, 90.0000, 95.2381, 95.2381),
    "003 s2_007": (28.0000, 33.3333, 40.0000, 40.0000, 43.4783, 46.5116, 39.1304, 43.4783),
    "004 s2_004": (100, 100, 100, 100, 100, 100, 100, 100),
    "004 s2_008": (48.8889, 51.4286, 48.8889, 48.8889, 33.3333, 37.2093, 25.0000, 25.0000),
    "005 s2_005": (85.1852, 85.0000, 85.1852, 85.1852, 100, 100, 100, 100),
    "005 s2_007": (27.1186, 32.6531, 33.8983, 33.8983, 46.5116, 55.5556, 46.5116, 51.1628),
    "006 s2_006": (100, 100, 100, 100, 100, 100, 100, 100),
    "006 s3_003": (37.8378, 41.3793, 27.0270, 27.0270, 28.5714, 32.2581, 32.6531, 32.6531),
}


def schema(columns):
    return ", ".join(f"{c} string" for c in columns)


def entities(spark, rows):
    """Rows of (id, name, address) in one country, or with the country given."""
    full = [r if len(r) == 4 else (*r, "IN") for r in rows]
    return spark.createDataFrame(full, schema(ENTITY))


def pairs(spark, rows):
    return spark.createDataFrame(list(rows), schema(PAIR))


def golden_pairs():
    return [(f"s1_{key[:3]}", key[4:]) for key in GOLDEN]


def truth(spark, rows=TRUTH):
    return spark.createDataFrame(rows, "source1_entity_id string, matched_entity_ids string")


def as_set(df):
    rows = [tuple(r) for r in df.select(*PAIR).collect()]
    assert len(rows) == len(set(rows)), "repeated pairs"
    return set(rows)


def short(found):
    """Pairs as '002 s2_002'."""
    return {f"{a[3:]} {b}" for a, b in found}


MESSY = [
    ("alpha beta gamma", "1 road", "FR"),
    ("alpha beta gamma", None, "FR"),
    ("alpha beta gamma", "1 road", None),
    ("Alpha Beta Gamma", "1 Road", "FR"),
    ("alpha  beta", " 1 road ", "FR"),
    ("beta beta beta", "road road", "DE"),
    ("abc", "x", "DE"),
    ("", "", "DE"),
    ("   ", "\t", "DE"),
    (None, "1 road", "FR"),
    ("ééé çà beta", "rue de l'été", "FR"),
    ("smile 😀😀😀 beta", "road 😀", "FR"),
    ("alpha delta", "2 road", "FR"),
    ("alpha delta epsilon", "2 road", "DE"),
    ("x" * 90 + " tail", "y" * 120, "FR"),
    ("x" * 90 + " tail", "y" * 121, "FR"),
]


def messy(prefix, times=1):
    """All messy rows ``times`` times, the ids of the first three repeated."""
    rows = [(f"{prefix}{t}_{i}", *r) for t in range(times) for i, r in enumerate(MESSY)]
    return rows + [(rows[i][0], *MESSY[-i - 1]) for i in range(3)]
