"""A training-corpus pipeline over ``documents`` (part of lendlens.llm).

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; run() writes each result as Parquet in the shared folder and reads it
again for the next stage. All stages but the last return the columns of
documents:

1. quality: rows that the base rules or the adaptive thresholds reject go;
2. near_duplicates: of each SimHash group (4-word shingles, 4 bits) the row of
   the smallest doc_id stays;
3. decontamination: rows of which a twentieth or more of the words lie in
   13-word benchmark windows go;
4. pii: personal data in the text is replaced by its kind, n_chars follows;
5. packing: the pieces of all texts with their sequence and place.

Rows with null texts fail the quality rules; an empty table passes through as
an empty table. Further columns of documents are kept up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lendlens.llm.common import cut, fresh, table
from lendlens.llm.decontaminate import decontaminate
from lendlens.llm.packing import pack
from lendlens.llm.pii import find_pii, redact
from lendlens.llm.quality import quality_rules
from lendlens.llm.simhash import simhash_dedup

TOKENIZER = "word_bpe_49k.json"

#: No SQL: adaptive thresholds come from sketches and fingerprints from XXH64.
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    (q,) = fresh(docs, "quality")
    return quality_rules(docs).filter(F.col(f"{q}.kept")).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    return simhash_dedup(docs)


def decontamination(spark, docs, sf_dir):
    (c,) = fresh(docs, "contamination")
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.filter(~F.col(f"{c}.contaminated")).select(*docs.columns)


def pii(spark, docs, sf_dir):
    (p,) = fresh(docs, "pii")
    found = find_pii(docs)
    (t,) = fresh(found, "redacted")
    clean = found.withColumn(t, F.when(F.size(p) > 0, redact(F.col("text"), F.col(p))))
    values = {"text": F.coalesce(t, "text")}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.coalesce(F.length(t).cast(docs.schema["n_chars"].dataType), "n_chars")
    return clean.select(*[values[c].alias(c) if c in values else F.col(c) for c in docs.columns])


def packing(spark, docs, sf_dir):
    return pack(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("pii", pii), ("packing", packing)]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
