"""Parameters of the registered queries on the driver tables.

The driver's clean tables have counts in the hundreds, not millions, so the
bands and thresholds are scaled to them; everything else keeps the reference
defaults from ``epitrend.config``."""

NATION_BANDS = ((1, 10), (1, 50), (1, 100), (100, 150), (150, 200), (200, 300), (300, 400))
CUSTOMER_BANDS = ((1, 100), (1, 200), (1, 300), (100, 200), (200, 300), (300, 400), (400, 500))
QUALIFY = {"min_rows": 30, "on": "1998-06-01", "gt": 250}
AS_OF = "1998-06-01"
BASELINE = "CUSTOMER_1"
CURVES = ("CUSTOMER_0", "CUSTOMER_1")
THRESHOLD = 100
RAW_KEEP = ("event_id", "file")
AS_OF_LATE = "1998-01-01"
BAND_STATE_CUT = "1998-03-17"  # the first part of the calendar that the state covers
# Country names given to the 25 nations, in the order of their keys.
COUNTRY_NAMES = ("Australia", "Austria", "Brazil", "Chile", "Colombia", "Egypt", "Estonia", "France", "Germany",
                 "Greece", "India", "Indonesia", "Iran", "Iraq", "Italy", "Japan", "Mexico", "Nigeria", "Norway",
                 "Peru", "Slovakia", "Slovenia", "Spain", "Switzerland", "Uruguay")
