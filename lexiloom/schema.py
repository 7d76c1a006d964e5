"""Column types shared by the readers, operators and writers."""

from pyspark.sql import types as T

ENTITIES_DDL = "array<struct<type:string,filler:string>>"

ENTITY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("filler", T.StringType()),
])
ENTITIES = T.ArrayType(ENTITY)

UTTERANCE = T.StructType([
    T.StructField("sentence", T.StringType()),
    T.StructField("intent", T.StringType()),
    T.StructField("entities", ENTITIES),
])

# The header of a review file. `Comments` may be absent.
REVIEW_COLUMNS = [
    "Sample_ID", "Original_Sentence", "Original_Intent", "Original_Entities",
    "Augmented_Sentence", "Augmented_Intent", "Augmented_Entities",
    "Augmentation_Method", "Quality_Score_1_5", "Naturalness_Score_1_5",
    "Comments", "Approved_Yes_No",
]
REVIEW_REQUIRED = [c for c in REVIEW_COLUMNS if c != "Comments"]

TRAINING_COLUMNS = [
    "sentence", "intent", "entities", "_augmented", "_augmentation_method",
    "_original_sentence", "_quality_score", "_naturalness_score",
    "_review_timestamp", "_sample_id",
]
