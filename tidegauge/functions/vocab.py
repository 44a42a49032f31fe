"""The identifiers that outcomes, checks and events carry."""

BASE = "http://placeholder.catalogue.ceh.ac.uk"
PASS = f"{BASE}/pass"
FAIL = f"{BASE}/fail"
NULL_CHECK = f"{BASE}/qc/null/value"
ORDER_CHECK = f"{BASE}/qc/timing/order"
SPACING_CHECK = f"{BASE}/qc/timing/intendedspacing"
META_VALUE = f"{BASE}/qc/meta/value/range/"
META_IDENTITY = f"{BASE}/qc/meta/identity/"
SPIKE = f"{BASE}/qc/delta/spike/"
STEP = f"{BASE}/qc/delta/step/"
SIGMA = f"{BASE}/qc/sigma/"
RANGE = f"{BASE}/qc/range/"
EVENT_NULL_AGGREGATE = f"{BASE}/event/null/aggregate/"
EVENT_NULL_CONSECUTIVE = f"{BASE}/event/null/consecutive"
EVENT_ORDER = f"{BASE}/event/timing/order"
EVENT_SPACING = f"{BASE}/event/timing/spacing"
JOB_THRESHOLD, JOB_DERIVED = "threshold", "derived"
MODEL_DELTA, MODEL_SIGMA, MODEL_RANGE = f"{BASE}/qc/delta", f"{BASE}/qc/sigma", f"{BASE}/qc/range"
MODEL_LAKE = f"{BASE}/derived/lake-analyzer"
NOT_A_VALUE = "NotAValue"

#: The identity of a series.
SERIES = ["feature", "procedure", "observableproperty"]
