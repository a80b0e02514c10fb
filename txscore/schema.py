"""Table schemas."""

from pyspark.sql import types as T

from txscore.constants import ORDINAL

# --- fixed values: the 22 fields of a transaction, in file order ---
TRANSACTION = T.StructType([
    T.StructField("trans_date_trans_time", T.StringType()),
    T.StructField("cc_num", T.LongType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("first", T.StringType()),
    T.StructField("last", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("city_pop", T.IntegerType()),
    T.StructField("job", T.StringType()),
    T.StructField("dob", T.StringType()),
    T.StructField("trans_num", T.StringType()),
    T.StructField("unix_time", T.LongType()),
    T.StructField("merch_lat", T.DoubleType()),
    T.StructField("merch_long", T.DoubleType()),
    T.StructField("is_fraud", T.IntegerType()),
])

# The training files carry the row ordinal as a first column.
TRANSACTION_FILE = T.StructType([T.StructField(ORDINAL, T.IntegerType())] + TRANSACTION.fields)

# --- fixed values: the 10 columns of the serving table ---
SCORED = T.StructType([
    T.StructField("trans_num", T.StringType()),
    T.StructField("trans_date_trans_time", T.StringType()),
    T.StructField("cc_num", T.LongType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("is_fraud", T.IntegerType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("prob_0", T.DoubleType()),
    T.StructField("prob_1", T.DoubleType()),
])

METRICS_RECORD = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("auc_roc", T.DoubleType()),
    T.StructField("auc_pr", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("tp", T.LongType()),
    T.StructField("tn", T.LongType()),
    T.StructField("fp", T.LongType()),
    T.StructField("fn", T.LongType()),
    T.StructField("train_seconds", T.DoubleType()),
])
