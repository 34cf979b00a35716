"""Business values. Every operator takes the ones it uses as arguments with these defaults."""

from __future__ import annotations

# These must be exactly as given for results to be right.

SINCE = "2024-01-02 00:00:00"

TAG_ON_CODES = (1, 2, 4)
TAG_OFF_CODES = (3, 5)
REFUND_CODE = 3
PLAIN_TAG_OFF_CODE = 5

PROGRAM_CONTRACT = 520

FARE_CATEGORIES = {0: "Adult", 1: "Senior", 2: "RTC", 3: "Youth"}
OTHER_FARE_CATEGORY = "Undefined"

TAG_OFF_ONLY = "Tag-off Only"
TAG_ON_ONLY = "Tag-on Only"
TAG_ON_AND_OFF = "Tag-on and Tag-off"

UNKNOWN_NAME = "Unknown"
NO_ROUTE = "N/A"
ANY_PLACE = "0"

# participant, route types, label; a trailing * means "starts with".
OPERATOR_LABELS = (
    ("Golden Gate Transit", ("Marin Transit Route",), "Marin Transit"),
    ("Napa Solano", ("FAST Local",), "FAST"),
    (
        "Napa Solano",
        ("Napa VINE 29 to BART", "Napa VINE Express", "Napa VINE Local"),
        "Napa Vine",
    ),
    ("Napa Solano", ("SolTrans Express", "SolTrans S82"), "SolTrans"),
    ("Napa Solano", ("Vacaville Local",), "Vacaville"),
    ("East Bay", ("County Connection*",), "County Connection"),
    ("East Bay", ("TriDelta*",), "Tri Delta"),
    ("East Bay", ("WestCAT*",), "WestCAT"),
    ("East Bay", ("Wheels Local",), "Wheels"),
    ("Corridor 101", ("Petaluma Transit Local Route",), "Petaluma"),
    ("Corridor 101", ("Santa Rosa City Bus Local Route",), "Santa Rosa"),
)
