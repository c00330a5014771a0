"""Parameters of the registered queries over the fixture tables.

The driver's tables cover ship dates 1995-2001, so the year window is
1995-2000 (2001 is partial) and the chronological cut is 1998, in place of
the reference's 2015-2023 window and 2021 cut.
"""

YEARS = (1995, 2000)
CUT_YEAR = 1998
N_TYPES = 10
N_LOCATIONS = 50
SAMPLE_P = 0.05
SEED = 42
SHUFFLE_CAP = 200_000
CAP_ROWS = 10_000
NULL_KEY_CAP = 500
TEST_FRACTION = 0.2
PREVIEW_ROWS = 10
TOP_TYPES_REPORT = 20

# The models of the registered queries: the reference's rounds, rate, depth and
# patience (its 1500 rounds are those of the classifier notebook).
FOREST = {"num_trees": 50, "max_depth": 8}
BOOSTED_CLASSIFIER = {"max_iter": 1500, "step_size": 0.05, "max_depth": 8, "max_leaves": 63, "patience": 50}
BOOSTED_REGRESSOR = {"max_iter": 500, "step_size": 0.05, "max_depth": 4}
