"""The hand-made micro graph of FIXTURES.md section 2."""

import datetime as dt

from pyspark.sql.types import ArrayType, DateType, StringType, StructField, StructType

VINTAGE = dt.date(2024, 9, 30)

COUNTRIES = {
    "A": ["USA"], "B": ["AFG"], "C": ["IRN"], "D": None, "E": [], "F": ["ALB"], "G": None,
    "H": ["PRK"], "P": ["USA"], "Q": [], "R": ["RUS"], "9999": None, "": None,
}

ROWS = [
    ("T1", "A", "B", "2024-05-01"),
    ("T2", "A", "B", "2024-06-01"),
    ("T3", "B", "A", "2024-06-02"),
    ("T4", "A", "C", "2024-06-03"),
    ("T5", "C", "C", "2024-06-04"),
    ("T6", "D", None, "2024-06-05"),
    ("T7", "E", "9999", "2024-06-06"),
    ("T8", "F", "H", "2024-03-30"),
    ("T9", "F", "G", "2024-09-30"),
    ("T10", "H", "A", "2023-12-15"),
    ("T11", "", "A", "2024-06-07"),
    ("T12", "A", "G", "2024-10-01"),
    ("T13", "P", "Q", "2024-07-01"),
    ("T14", "Q", "R", "2024-07-02"),
    ("T15", "R", "P", "2024-07-03"),
    ("T16", None, "A", "2024-07-04"),
]

DRIVERS = ["A", "B", "C", "D", "E", "F", "P", "Q", "R", "Z"]

SCHEMA = StructType(
    [
        StructField("EXT_ENTITYID", StringType()),
        StructField("combinedCountryCodes", ArrayType(StringType())),
        StructField("COUNTER_PARTY_ENTITYID", StringType()),
        StructField("COUNTER_PARTY_COMBINEDCOUNTRYCODES", ArrayType(StringType())),
        StructField("TRXN_REF_ID", StringType()),
        StructField("VINTAGE_DT", DateType()),
        StructField("POSTING_DATE", DateType()),
    ]
)


def transactions(spark):
    data = [
        (e, COUNTRIES.get(e) if e is not None else None, c, COUNTRIES.get(c) if c is not None else None,
         ref, VINTAGE, dt.date.fromisoformat(d))
        for ref, e, c, d in ROWS
    ]
    return spark.createDataFrame(data, SCHEMA)


def drivers(spark):
    return spark.createDataFrame([(d, VINTAGE) for d in DRIVERS], "EXT_ENTITYID string, VINTAGE_DT date")


# Golden values (FIXTURES.md): id -> (degree, pagerank, label, community size,
# density, average degree, network size, vhrg neighbours)
GOLDEN = {
    6: {
        "A": (3, 0.755478911, "B", 1, 0.0, 0.0, 3, 3),
        "B": (2, 0.544043978, "A", 1, 0.0, 0.0, 3, 0),
        "C": (3, 3.159785918, "C", 1, 0.0, 2.0, 3, 2),
        "D": (None, 0.222965440, "D", 1, 0.0, 0.0, 1, 0),
        "E": (None, 0.222965440, "E", 1, 0.0, 0.0, 1, 0),
        "F": (1, 0.222965440, "G", 1, 0.0, 0.0, 2, 0),
        "G": (1, 0.412486065, "F", 1, 0.0, 0.0, 2, 0),
        "P": (2, 1.486436269, "P", 3, 1.0, 2.0, 3, 1),
        "Q": (2, 1.486436269, "P", 3, 1.0, 2.0, 3, 1),
        "R": (2, 1.486436269, "P", 3, 1.0, 2.0, 3, 0),
    },
    12: {
        "A": (4, 1.178360763, "B", 2, 0.0, 0.0, 6, 3),
        "B": (2, 0.704790343, "A", 3, 0.0, 0.0, 6, 0),
        "C": (3, 3.843784452, "C", 1, 0.0, 2.0, 6, 2),
        "D": (None, 0.203987019, "D", 1, 0.0, 0.0, 1, 0),
        "E": (None, 0.203987019, "E", 1, 0.0, 0.0, 1, 0),
        "F": (2, 0.203987019, "B", 2, 0.0, 0.0, 6, 0),
        "G": (1, 0.290681502, "A", 3, 0.0, 0.0, 6, 0),
        "H": (2, 0.290681502, "A", 3, 0.0, 0.0, 6, 0),
        "P": (2, 1.359913460, "P", 3, 1.0, 2.0, 3, 1),
        "Q": (2, 1.359913460, "P", 3, 1.0, 2.0, 3, 1),
        "R": (2, 1.359913460, "P", 3, 1.0, 2.0, 3, 0),
    },
}
