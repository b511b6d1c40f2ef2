"""Readers and writers of the file formats: FASTA, tables with a JSON line on top, locations, taxa, hits, reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import intervals

TAXA = "tax_id int, species string, common_name string, blast_div string, div string"
HITS = "q_id string, q_pos int, tax_id int, s_id string, s_pos int, len int, l2 long, mismatches int"
LOCS = "seq_id string, from1 string, to1 string"
ACTIONS = "seq_id string, start_pos long, end_pos long, seq_len long, action string, div string, agg_cov string, top_tax_name string"
REPORT = "seq_id string, len long, tracks string, cvg_by_all long, sep0 string, tax_name string, " + ", ".join(f"tax_id{i} string, div{i} string, cvg_by_div{i} string, cvg_by_tax{i} string, score{i} string, sep{i} string" for i in range(1, 5))
#: Letters that a sequence line may hold.
ALPHABET = "ACGTUMRWSYKVHDBNX-"


def read_fasta(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    """(seq_id, defline, seq); records may be empty. Letters are raised; others than IUPAC codes are an error."""
    r = spark.read.option("lineSep", "\n>").text(path)
    body = F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "")
    head = F.substring_index(body, "\n", 1)
    seq = F.upper(F.regexp_replace(F.when(F.instr(body, "\n") > 0, body.substr(F.length(head) + 1, F.length(body))).otherwise(""), r"\s", ""))
    d = r.filter(F.trim(body) != "").select(F.regexp_extract(head, r"^\s*(\S+)", 1).alias("seq_id"), head.alias("defline"), seq.alias("seq"))
    if validate:
        d = d.withColumn("seq", F.when(F.col("seq").rlike(f"[^{ALPHABET}]"), F.raise_error(F.concat(F.lit("bad letter in "), "seq_id"))).otherwise(F.col("seq")))
    return d


def assert_unique_ids(df: DataFrame, column: str = "seq_id") -> DataFrame:
    twice = df.groupBy(column).agg(F.count("*").alias("_n")).filter("_n > 1").select(F.raise_error(F.concat(F.lit("id occurs twice: "), column)).cast("string").alias(column))
    return df.join(F.broadcast(twice.limit(1)), column, "left_anti")


def chunks(seqs: DataFrame, stride: int = 100_000, overlap: int = 100) -> DataFrame:
    """(seq_id, offset, seq) pieces of stride letters with an overlap; an empty sequence is one empty piece."""
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.length("seq") - 1, F.lit(0)), F.lit(stride)))
    d = seqs.select("seq_id", "seq", at.alias("offset"))
    return d.select("seq_id", "offset", F.col("seq").substr(F.col("offset") + 1, F.lit(stride + overlap)).alias("seq"))


def write_fasta(seqs: DataFrame, path: str, width: int = 80) -> None:
    """(id, seq) with wrapped lines."""
    wrapped = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    seqs.select(F.concat(F.lit(">"), "id", F.lit("\n"), wrapped)).write.text(path)


def metaline(path: str, spark: SparkSession) -> dict:
    """Name, versions and content of the JSON line that opens a table."""
    first = next((r.value for r in spark.read.text(path).filter(F.col("value").startswith("##")).limit(1).collect()), None)
    if first is None:
        raise ValueError(f"{path} has no header line")
    (name, major, minor), *rest = json.loads(first[2:])
    return {"name": name, "major": major, "minor": minor, "content": rest[0] if rest else {}}


def make_metaline(name: str, major: int, minor: int, **content) -> str:
    return "##" + json.dumps([[name, major, minor], content])


def check_metaline(path: str, spark: SparkSession, name: str, major: int) -> dict:
    m = metaline(path, spark)
    if (m["name"], m["major"]) != (name, major):
        raise ValueError(f"{path}: expected {name} version {major}, found {m['name']} {m['major']}")
    return m


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated; blanks around fields, empty lines and lines that start with # are left out; strict numbers."""
    return spark.read.csv(path, sep="\t", comment="#", schema=schema, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, mode="FAILFAST", quote="")


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", quote="", emptyValue="")


def read_taxa(spark, path) -> DataFrame:
    d = read_tsv(spark, path, TAXA).withColumn("div", F.when(F.col("div") == "synthetic", "synt:synthetic").otherwise(F.col("div")))
    zero = spark.createDataFrame([(0, "NULL", "NULL", "NULL", "NULL")], TAXA)
    return d.withColumn("species", F.regexp_replace("species", r"\s+(mitochondrion|chloroplast|plastid)$", "")).unionByName(zero)


def read_locations(spark, path) -> DataFrame:
    """(seq_id, pos, len) merged; "." "." is the whole sequence (pos 1, len null)."""
    d = read_tsv(spark, path, LOCS)
    whole = d.filter("from1 = '.'").select("seq_id").distinct().withColumns({"pos": F.lit(1).cast("long"), "len": F.lit(None).cast("long")})
    part = d.filter("from1 <> '.'").join(whole.select("seq_id"), "seq_id", "left_anti").select("seq_id", F.col("from1").cast("long").alias("pos"), (F.col("to1").cast("long") - F.col("from1").cast("long") + 1).alias("len"))
    return intervals.merge(part, ["seq_id"]).unionByName(whole)


def read_report(spark, path) -> DataFrame:
    """Rows of the 30-column report with their taxa as an array; N is taken off the length."""
    d = read_tsv(spark, path, REPORT)
    t = F.split("tracks", ",")
    taxon = lambda i: F.struct(F.col(f"tax_id{i}").try_cast("int").alias("tax_id"), F.col(f"div{i}").alias("div"), *(F.col(f"{c}{i}").try_cast("int").alias(c) for c in ("cvg_by_div", "cvg_by_tax", "score")))
    taxa = F.filter(F.array(*map(taxon, range(1, 5))), lambda x: x["div"].isNotNull() & (x["div"] != ""))
    names = ("xp", "lc", "co", "n", "xc")
    d = d.select("seq_id", "len", *(t[i].cast("int").alias(c) for i, c in enumerate(names)), "cvg_by_all", "tax_name", taxa.alias("taxa"))
    return d.withColumn("len", F.col("len") - F.col("n"))


def read_actions(spark, path) -> DataFrame:
    """Both dialects of action reports as (seq_id, pos, len, action): eight columns, or five with ranges."""
    r = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.split("value", "\t").alias("c"))
    eight = r.filter(F.size("c") >= 8).select(F.col("c")[0].alias("seq_id"), F.col("c")[1].cast("long").alias("pos"), (F.col("c")[2].cast("long") - F.col("c")[1].cast("long") + 1).alias("len"), F.col("c")[4].alias("action"))
    five = r.filter(F.size("c") < 8).select(F.col("c")[0].alias("seq_id"), F.explode(scalars.parse_ranges(F.when(F.col("c")[3] == "", F.concat(F.lit("1.."), F.col("c")[1])).otherwise(F.col("c")[3]))).alias("r"), F.col("c")[2].alias("action")).select("seq_id", "r.pos", "r.len", "action")
    return eight.unionByName(five)


def read_manifest(spark, path) -> DataFrame:
    m = spark.read.option("multiLine", True).json(path).select(F.explode("fileDetails").alias("f"))
    return m.select(F.col("f.fileName").alias("path"), F.col("f.fileSize").cast("long").alias("size"), F.col("f.hashValue").alias("digest"))


def file_digests(spark, path) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("path"), F.col("length").alias("size"), F.md5("content").alias("digest"))


def fetch(seqs: DataFrame, locations: DataFrame) -> DataFrame:
    """(id, seq) of the asked ranges (seq_id, pos, len; len null: to the end)."""
    j = seqs.join(locations, "seq_id")
    n = F.coalesce("len", F.length("seq") - F.col("pos") + 1)
    name = F.when(F.col("len").isNull(), F.col("seq_id")).otherwise(F.concat("seq_id", F.lit(":"), "pos", F.lit("-"), F.col("pos") + n - 1))
    return j.select(name.alias("id"), F.col("seq").substr(F.col("pos").cast("int"), n.cast("int")).alias("seq"))


def write_index(index: DataFrame, name: str, buckets: int = 64) -> None:
    """Postings as a table bucketed and sorted by word, so that seed joins need no shuffle of the index."""
    index.write.mode("overwrite").bucketBy(buckets, "word").sortBy("word").saveAsTable(name)


def extend_metaline(line: str, **content) -> str:
    """A header line with more content, such as facts of the run or of the subject set; what is there already is replaced."""
    head, *rest = json.loads(line.removeprefix("##"))
    return "##" + json.dumps([head, {**(rest[0] if rest else {}), **content}])


def read_id_map(spark, path) -> DataFrame:
    """Distinct (seq_id, tax_id)."""
    return read_tsv(spark, path, "seq_id string, tax_id int").filter("seq_id is not null").distinct()


def lookup(spark, path, pattern: str) -> DataFrame:
    """Lines of text files, gz or plain, that a pattern matches."""
    return spark.read.text(path).filter(F.col("value").rlike(pattern))


def read_manifest_files(spark, path) -> DataFrame:
    """The lines of all files that a manifest (one path a line, gz or plain) names."""
    paths = [r.value.strip() for r in spark.read.text(path).collect() if r.value.strip() and not r.value.startswith("#")]
    return spark.read.text(paths)


def subject_set(spark, path) -> tuple[DataFrame, DataFrame]:
    """(taxa, ids) from rows of seq_id, tax_id, species, common_name, blast_div, div; rows without six fields are an error."""
    rows = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.split("value", "\t", -1).alias("c"))
    field = lambda i: F.when(F.size("c") == 6, F.col("c")[i]).otherwise(F.raise_error(F.lit("a row has not six fields")))
    names = ["seq_id", "tax_id", "species", "common_name", "blast_div", "div"]
    d = rows.select(*(field(i).alias(n) for i, n in enumerate(names))).withColumn("tax_id", F.col("tax_id").cast("int"))
    return d.select(*names[1:]).distinct(), d.select("seq_id", "tax_id").distinct()


def with_division(rows: DataFrame, mapping: DataFrame, primary: str, secondary: str) -> DataFrame:
    """rows with div by a mapping (name, div): of the first name, else of the second, else unkn:unknown. A mapping has a few dozen rows."""
    m = F.broadcast(mapping)
    a = m.select(F.col("name").alias(primary), F.col("div").alias("_a"))
    b = m.select(F.col("name").alias(secondary), F.col("div").alias("_b"))
    d = rows.join(a, primary, "left").join(b, secondary, "left")
    return d.withColumn("div", F.coalesce("_a", "_b", F.lit("unkn:unknown"))).drop("_a", "_b")


def mask(seqs: DataFrame, ranges: DataFrame, hard: bool = False) -> DataFrame:
    """(seq_id, seq) with the letters of ranges (seq_id, pos, len) in lower case, or as N; ranges may overlap."""
    r = intervals.merge(ranges, ["seq_id"]).groupBy("seq_id").agg(F.array_sort(F.collect_list(F.struct("pos", "len"))).alias("r"))
    d = seqs.join(r, "seq_id", "left")
    text = lambda x: F.repeat(F.lit("N"), F.length(x)) if hard else F.lower(x)

    def step(done, x):
        before = F.substring(F.col("seq"), done["at"], F.greatest(x["pos"].cast("int") - done["at"], F.lit(0)))
        inside = F.substring(F.col("seq"), x["pos"].cast("int"), x["len"].cast("int"))
        return F.struct((x["pos"] + x["len"]).cast("int").alias("at"), F.concat(done["out"], before, text(inside)).alias("out"))

    none = F.array().cast("array<struct<pos:bigint,len:bigint>>")
    done = F.aggregate(F.coalesce("r", none), F.struct(F.lit(1).alias("at"), F.lit("").alias("out")), step)
    return d.select("seq_id", done.alias("x")).join(seqs.select("seq_id", F.col("seq").alias("_s")), "seq_id").select(
        "seq_id", F.concat(F.col("x.out"), F.substring(F.col("_s"), F.col("x.at"), F.length("_s"))).alias("seq"))


def store_index(index: DataFrame, path: str, buckets: int = 64) -> None:
    """Postings as Parquet folders by bucket of the word, sorted by word, so that a lookup reads one bucket and few row groups."""
    d = index.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int"))
    d.repartition(buckets, "bucket").sortWithinPartitions("bucket", "word").write.partitionBy("bucket").parquet(path)


def load_index(spark, path: str, words: list | None = None) -> DataFrame:
    """The postings, or those of a short list of words; a full join reads the table as a whole."""
    d = spark.read.parquet(path)
    return d.drop("bucket") if words is None else d.filter(F.col("word").isin(words)).drop("bucket")
