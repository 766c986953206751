"""Constants of the data model.

Everything under "Fixed values" must stay equal to what the original
application used, or stored tables, models and grids stop lining up.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Grid definitions (affine, one per level): name, rx, ry, sx, sy, tx, ty.
TILE_GRID = dict(name="tile", rx=1.0, ry=-1.0, sx=150000.0, sy=150000.0,
                 tx=2565585.0, ty=3314805.0)
CHIP_GRID = dict(name="chip", rx=1.0, ry=-1.0, sx=3000.0, sy=3000.0,
                 tx=2565585.0, ty=3314805.0)

# Raster chips are 100 x 100 pixels.
CHIP_SHAPE = (100, 100)

# Table names.
CHIP_TABLE = "chip"
PIXEL_TABLE = "pixel"
SEGMENT_TABLE = "segment"
TILE_TABLE = "tile"
DETECTION_TABLE = "data"
# Auxiliary series of a namespace (not a table of the keyed store).
AUX_TABLE = "aux"

# Primary keys of the stored tables.
CHIP_KEY = ["cx", "cy"]
PIXEL_KEY = ["cx", "cy", "px", "py"]
SEGMENT_KEY = ["cx", "cy", "px", "py", "sday", "eday"]
TILE_KEY = ["tx", "ty"]

# Reflectance / thermal fill value, and the day number given to the
# "no change model" sentinel segment (start = end = break = day 1).
FILL = -9999
SENTINEL_DAY = 1

# Version used in the output namespace name "{ard}_{aux}_ccdc_{version}".
VERSION = "1.0"
NAMESPACE_FORMAT = "{0}_{1}_ccdc_{2}"

# Random forest: number of trees, StringIndexer/VectorIndexer settings.
NUM_TREES = 500
MAX_CATEGORIES = 8

# Band name -> two letter column prefix in the segment table, in table order.
BANDS = ["blue", "green", "red", "nir", "swir1", "swir2", "thermal"]
BAND_PREFIX = {"blue": "bl", "green": "gr", "red": "re", "nir": "ni",
               "swir1": "s1", "swir2": "s2", "thermal": "th"}
# Series column holding each band in the ARD time series.
BAND_SERIES = {"blue": "blues", "green": "greens", "red": "reds", "nir": "nirs",
               "swir1": "swir1s", "swir2": "swir2s", "thermal": "thermals"}

# Feature columns of the classifier, order significant.
FEATURE_COLUMNS = ["blmag", "grmag", "remag", "nimag", "s1mag", "s2mag", "thmag",
                   "blrmse", "grrmse", "rermse", "nirmse", "s1rmse", "s2rmse", "thrmse",
                   "blcoef", "grcoef", "recoef", "nicoef", "s1coef", "s2coef", "thcoef",
                   "blint", "grint", "reint", "niint", "s1int", "s2int", "thint",
                   "dem", "aspect", "slope", "mpw", "posidex"]

# Training labels excluded by the first trends value.
EXCLUDED_TRENDS = (0, 9)

# ---------------------------------------------------------------------------
# Derived / our own choices
# ---------------------------------------------------------------------------

# Proleptic Gregorian ordinal of 1970-01-01 (Python date.toordinal()).
UNIX_EPOCH_ORDINAL = 719163

# Table of finished chips (a resumed run leaves them out).
LEDGER_TABLE = "ledger"

# Detector defaults (Zhu & Woodcock 2014; kept as arguments everywhere).
DETECTION_BANDS = ["green", "red", "nir", "swir1", "swir2"]
CHI2_99_5 = 15.086          # chi-square 0.99 quantile, 5 degrees of freedom
PEEK_SIZE = 6               # consecutive exceedances that make a break
MIN_OBSERVATIONS = 12       # clear observations to initialise a model
DAYS_PER_YEAR = 365.25
