"""Readers: each gives one row per utterance. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palaver.functions.text import url_tail_id

ANNOMI_SCHEMA = "transcript_id string, utterance_id long, utterance_text string, interlocutor string, video_url string, timestamp string, client_talk_type string, main_therapist_behaviour string"
MELD_SCHEMA = "Dialogue_ID long, Utterance_ID long, Utterance string, Speaker string, Emotion string, Sentiment string, Old_Dialogue_ID long, Old_Utterance_ID long"
DAILYTALK_SCHEMA = "map<string,map<string,struct<dialog_idx:bigint,utterance_idx:bigint,text:string,speaker:string,emotion:string,act:string>>>"
MUSTARD_SCHEMA = "map<string,struct<utterance:string,speaker:string,context:array<string>,context_speakers:array<string>,sarcasm:boolean>>"


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The named columns of a CSV file with a header; values may hold line breaks and doubled quotes."""
    wanted = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False)
    return raw.select(*[(F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])


def read_splits(spark: SparkSession, files: dict[str, str], schema: str = MELD_SCHEMA) -> list[DataFrame]:
    """One frame per file, tagged with its split, in the order given."""
    return [read_csv(spark, path, schema).withColumn("split", F.lit(split)) for split, path in files.items()]


def offset_union(frames: list[DataFrame], conv: str) -> DataFrame:
    """All frames, each one's ids moved up by the rows of those before it; the result must have no id twice."""
    out, rows = None, 0
    for df in frames:
        moved = df.withColumn(conv, (F.col(conv) + F.lit(rows)).cast("long"))
        out = moved if out is None else out.unionByName(moved, allowMissingColumns=True)
        rows += df.count()
    return out


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("doc"))


def nested_records(docs: DataFrame, column: str = "doc") -> DataFrame:
    """Rows of {conversation: {utterance: record}}, flattened."""
    inner = docs.select(F.explode(F.map_values(column)).alias("__c"))
    return inner.select(F.explode(F.map_values("__c")).alias("__r")).select("__r.*")


def context_and_target(docs: DataFrame, column: str = "doc") -> DataFrame:
    """Rows of {record: {context, utterance, ...}}: the context's utterances 0..n-1, then the target n.

    conv_id is the record's place in the file.
    """
    rec = docs.select(F.posexplode(F.map_entries(column)).alias("conv_id", "e"))
    rec = rec.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("e.key").alias("record_id"), "e.value.*")
    return context_rows(rec)


def context_rows(rec: DataFrame) -> DataFrame:
    """rec: conv_id, record_id, utterance, speaker, context, context_speakers, sarcasm."""
    turns = F.transform(F.arrays_zip("context", "context_speakers"), lambda x: F.struct(x["context"].alias("utterance"), x["context_speakers"].alias("speaker"), F.lit("context").alias("type_utter")))
    target = F.array(F.struct(F.col("utterance").alias("utterance"), F.col("speaker").alias("speaker"), F.lit("target").alias("type_utter")))
    flat = rec.select("conv_id", "record_id", F.col("sarcasm").alias("scam"), F.posexplode(F.concat(turns, target)).alias("utter_id", "t"))
    return flat.select("conv_id", F.col("utter_id").cast("long").alias("utter_id"), "t.utterance", "t.speaker", "scam", "t.type_utter", "record_id")


def read_dailytalk(spark: SparkSession, path: str) -> DataFrame:
    return nested_records(_json(spark, path, DAILYTALK_SCHEMA))


def read_mustard(spark: SparkSession, path: str) -> DataFrame:
    return context_and_target(_json(spark, path, MUSTARD_SCHEMA))


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, key (the path below the folder) of files, by one listing; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path")
    return files.withColumn("key", F.regexp_replace(F.expr(f"substring(path, instr(path, '{folder.rstrip('/').split('://')[-1]}') + {len(folder.rstrip('/').split('://')[-1])})"), "^/+", ""))


def with_files(df: DataFrame, files: DataFrame, key: Column, required: bool, name: str = "file_path") -> DataFrame:
    """The path of each row's file; without one the row goes (required) or its path is null."""
    return df.withColumn("__k", key).join(files.select(F.col("key").alias("__k"), F.col("path").alias(name)), "__k", "inner" if required else "left").drop("__k")


def annomi_file(url: Column) -> Column:
    return F.concat(url_tail_id(url), F.lit(".wav"))


def dailytalk_file(conv: Column, utter: Column, speaker: Column) -> Column:
    c, u, s = (x.cast("string") for x in (conv, utter, speaker))
    return F.concat(F.lit("data/"), c, F.lit("/"), u, F.lit("_"), s, F.lit("_d"), c, F.lit(".wav"))


def mustard_file(record: Column, kind: Column) -> Column:
    return F.when(kind == "context", F.concat(F.lit("context_final/"), record, F.lit("_c.mp4"))).otherwise(F.concat(F.lit("utterances_final/"), record, F.lit(".mp4")))


def meld_file(split: Column, conv: Column, utter: Column) -> Column:
    folders = {"train": "train_splits", "dev": "dev_splits_complete", "test": "output_repeated_splits_test"}
    folder = F.element_at(F.create_map(*[F.lit(x) for kv in folders.items() for x in kv]), split)
    return F.concat(folder, F.lit("/dia"), conv.cast("string"), F.lit("_utt"), utter.cast("string"), F.lit(".mp4"))


def header_schema(spark: SparkSession, path: str) -> StructType:
    """Every column of a CSV file with a header, as text."""
    return StructType([f for f in spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').schema if f.name and "Unnamed" not in f.name])


def read_merged(spark: SparkSession, folder: str, schema: str | StructType) -> DataFrame:
    return read_csv(spark, f"{folder}/metadata.csv", schema)
