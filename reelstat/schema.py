"""Canonical schemas (one name per concept, used everywhere)."""

from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("movie_id", T.IntegerType(), False),
    T.StructField("date", T.IntegerType(), False),
    T.StructField("rating", T.IntegerType(), False),
    T.StructField("category", T.IntegerType(), False),
])

RATING_COLUMNS = [f.name for f in RATINGS.fields]

USER_FACTORS = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("p", T.ArrayType(T.DoubleType(), False), False),
    T.StructField("bu", T.DoubleType(), False),
])

MOVIE_FACTORS = T.StructType([
    T.StructField("movie_id", T.IntegerType(), False),
    T.StructField("q", T.ArrayType(T.DoubleType(), False), False),
    T.StructField("bm", T.DoubleType(), False),
])

RUN_LOG = T.StructType([
    T.StructField("run", T.StringType(), False),
    T.StructField("iteration", T.IntegerType(), False),
    T.StructField("learning_rate", T.DoubleType(), False),
    T.StructField("valid_rmse", T.DoubleType(), True),
    T.StructField("probe_rmse", T.DoubleType(), True),
    T.StructField("accepted", T.BooleanType(), False),
])

RUN_PARAMS = T.StructType([
    T.StructField("run", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType(), False),
])

# Fixed values of the rating data model: category codes and their split.
# 1, 2, 3 and 6 are train (6 = "index ran out"), 4 is probe, 5 is test;
# inside train, category 2 is the validation set.
TRAIN_CATEGORIES = (1, 2, 3, 6)
PROBE_CATEGORY = 4
TEST_CATEGORY = 5
VALID_CATEGORY = 2
MISSING_CATEGORY = 6
SPLITS = ("train", "probe", "test")

# Fixed values of the 10-byte little-endian rating record:
# user u32 @0, movie u16 @4, date u16 @6, rating u8 @8, category u8 @9.
RECORD_BYTES = 10
RECORD_DTYPE = [("user", "<u4"), ("movie", "<u2"), ("date", "<u2"), ("rating", "u1"), ("category", "u1")]

# Our own record for ids or days beyond those fields: every value of RATINGS' user, movie and date fits.
WIDE_RECORD_DTYPE = [("user", "<i8"), ("movie", "<i4"), ("date", "<i4"), ("rating", "u1"), ("category", "u1")]

# Fixed values of the reference trainer (used as defaults, all overridable).
MEAN_RATING = 3.60861
LEARNING_RATE = 0.0001
LEARNING_DEC = 0.8
LEARNING_INC = 1.005
LEARNING_UP = 1.5
LEARNING_DOWN = 1.5
REG_USER = 0.002
REG_MOVIE = 0.002
BIAS_RATIO = 0.02
INIT_RANGE = 0.05
N_FACTORS = 40
N_ITERATIONS = 10
THRESHOLD = 0.0
