"""Hand-made edge rows, as a trip file would hold them."""

from dockflow.functions.trip import prepare
from dockflow.sources.schema import TRIP_FILE

C, E = "classic_bike", "electric_bike"
M, K = "member", "casual"
ROWS = [
    ("e1", C, "2023-01-02 08:00:00", "2023-01-02 08:10:00", "A", "B", M),
    ("e2", E, "2023-01-07 09:00:00.900", "2023-01-07 09:00:02.100", "A", "A", K),
    ("e3", C, "2023-12-31 23:50:00", "2024-01-01 00:10:00", "B", "A", M),
    ("e4", E, "2024-02-29 12:00:00", "2024-02-29 12:00:00", "A", "B", M),
    ("e5", E, "2024-03-01 12:00:00", "2024-03-02 12:00:00", "A", "B", K),
    ("e6", C, "2024-06-01 10:00:00", "2024-06-01 09:59:00", "A", "B", M),
    ("e7", C, "n/a", "2024-06-01 10:00:00", "A", "B", M),
    ("e8", C, "2024-09-01 07:00:00", "n/a", "A", "B", M),
    ("e9", E, "2024-06-02 15:00:00", "2024-06-02 15:20:00", None, "B", K),
    ("e10", C, "2024-11-05 06:00:00", "2024-11-05 06:30:00", "B", None, M),
]


def raw(spark, rows=ROWS):
    full = [
        (i, bike, start, end, a, a and f"{a}.01", b, b and f"{b}.02", 40.5, -74.0, 40.6, -74.1, user)
        for i, bike, start, end, a, b, user in rows
    ]
    return spark.createDataFrame(full, TRIP_FILE)


def trips(spark, rows=ROWS):
    return prepare(raw(spark, rows))


def records(frame):
    return [row.asDict(recursive=True) for row in frame.collect()]
