"""A corpus pipeline over documents: quality, exact copies, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir); docs is what the stage before returned, written as Parquet and read again. All but
the last return the columns of documents.

Defined results, for every stage: a null text counts as empty (and stays null); rows with a null doc_id are documents like others; of
repeated rows, exact dedup leaves one; texts of any length are read whole; extra columns stay as they are, also where their names
are those of a stage's own results; an empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from loomseq.llm import exact_dedup, jaccard_join, packing, passage_dedup, quality
from loomseq.llm.common import discard, release, table, work_dir

TAG = "pipeline"
#: Shortest passage, in bytes, that goes when it repeats: about 40 words, so that passages of 50 short words are among them.
PASSAGE = 256


def quality_stage(spark, docs, sf_dir):
    """Documents that the classifier accepts. It learns from the labelled rows of docs."""
    release(spark, TAG)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def exact_stage(spark, docs, sf_dir):
    """One of each group of equal texts."""
    release(spark, TAG)  # the stage before has been written
    return exact_dedup.exact_dedup(docs, TAG)


def near_stage(spark, docs, sf_dir):
    """One of each group of near copies."""
    release(spark, TAG)
    return jaccard_join.keep_one(docs, TAG)


def passage_stage(spark, docs, sf_dir):
    """Documents without passages of PASSAGE bytes or more that repeat."""
    release(spark, TAG)
    return passage_dedup.remove_passages(docs, PASSAGE, TAG)


def packing_stage(spark, docs, sf_dir):
    """Pieces of token sequences."""
    release(spark, TAG)
    return packing.pack(docs, with_ids=False, tag=TAG)


STAGES = [("quality classifier", quality_stage), ("exact dedup", exact_stage), ("n-gram Jaccard join", near_stage), ("suffix-array dedup", passage_stage), ("packing", packing_stage)]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{work_dir(spark)}/stage{k}-{uuid.uuid4().hex[:12]}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:  # nothing reads the stage before any more
                discard(spark, before)
            before = path
    return docs
