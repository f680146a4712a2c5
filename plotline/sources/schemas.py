"""Fixed schemas of every input and output (no inference at any source)."""

from pyspark.sql import types as T

S = T.StringType()

ANNOTATION = T.StructType(
    [T.StructField("article_id", S), T.StructField("narrative", S), T.StructField("subnarrative", S)]
)
FLAT_RECORD = T.StructType(
    [
        T.StructField(c, S)
        for c in ("article_id", "content", "narrative", "subnarrative", "narrative_subnarrative", "domain")
    ]
)
LABELS = T.StructType(
    [T.StructField("narrative", T.ArrayType(S)), T.StructField("subnarrative", T.ArrayType(S))]
)
NESTED_RECORD = T.StructType(
    [
        T.StructField("article_id", S),
        T.StructField("content", S),
        T.StructField("domain", S),
        T.StructField("labels", LABELS),
    ]
)
MERGED_RECORD = T.StructType(
    NESTED_RECORD.fields + [T.StructField("label", T.ArrayType(S)), T.StructField("language", S)]
)
#: What the classifier writes per fold (nested columns as JSON text).
FOLD_PREDICTION = T.StructType(
    [T.StructField("article_id", S), T.StructField("content", S), T.StructField("p_domains", T.IntegerType())]
)
TAXONOMY = T.StructType(
    [T.StructField("theme", S), T.StructField("narrative", S), T.StructField("subnarrative", S)]
)
OUTLINE_PAGE = T.StructType(
    [T.StructField("doc", S), T.StructField("page", T.IntegerType()), T.StructField("text", S)]
)
ENTITY_MENTION = T.StructType(
    [
        T.StructField("article_id", S),
        T.StructField("mention", S),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ]
)
