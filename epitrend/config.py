"""Defaults of every operator.

Fixed values: these equal the reference analysis's constants and must stay
as they are for the same results. Every operator takes them as parameters.
"""

# Fixed values (reference defaults), in the order the analysis uses them.
MIN_ROWS = 30                      # keep entities with at least 30 daily rows
QUALIFY_DATE = "2020-05-03"        # ... and on this date
QUALIFY_GT = 350                   # ... strictly more confirmed than this
DATE_PATTERNS = ("M-d-y", "M-d-yy", "y-M-d")   # tried in this order per file
YEAR_PREFIX = "2"                  # a parsed date is kept only if its text starts with 2
COUNTRY_PREFIX = "Country"         # first header starting with this is the entity
LAST_UPDATE_PREFIX = "Last"        # last header starting with this is the timestamp
MEASURES = ("Confirmed", "Deaths", "Recovered")
BANDS = (
    (1, 10),
    (1, 100),
    (1, 5000),
    (5000, 10000),
    (10000, 50000),
    (50000, 100000),
    (100000, 500000),
)
BASELINE = "Mexico"
TOP_K = 5
COMPARE_WITH = ("Peru", "Colombia", "Argentina", "South Africa", "Spain")
KMEANS_K = 5
REFIT_K = 3
SWEEP_KS = tuple(range(2, 11))
TRAIN_RATIO = 0.8
SEED = 42

# Canonical column names of the clean table.
ENTITY = "Country"
DATE = "Date"
LAST_UPDATE = "last_update"
CLEAN_COLUMNS = (DATE, ENTITY, "Confirmed", "Deaths", "Recovered", "Active")


def _bound(x: float) -> str:
    """A bound as part of a column name: whole numbers plain, 0.5 as 0_5."""
    text = str(int(x)) if float(x).is_integer() else repr(float(x))
    return text.replace(".", "_").replace("-", "m").replace("+", "")


def band_column(lo: float, up: float) -> str:
    return f"days_{_bound(lo)}_to_{_bound(up)}"
