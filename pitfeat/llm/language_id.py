"""Language identification by a byte-level convolutional network.

Filters of several widths with max pooling and a softmax, trained in numpy on a
bounded sample of labelled texts, then applied to batches of fixed-length
windows that cover each whole text.

Defined cases: a null text, and one without a letter, is ``und`` with score 0.
With no labelled row every text is ``und``. Repeated rows each get a row. Only
the text is looked at for a prediction; other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.llm.byteconv import ByteConv, softmax
from pitfeat.llm.text_classes import DOCUMENTS, class_counts, fitted, judged, sampled_windows, share_of_class

UNKNOWN = "und"


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          documents: int = DOCUMENTS) -> tuple[ByteConv | None, list[str]]:
    """Network and language names from rows with a language and some text."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("_k"), F.col(text).alias("_t"), F.col(lang).cast("string").alias("_l"))
    counts = class_counts(rows.select("_l"), "_l")
    return fitted(sampled_windows(share_of_class(rows, "_k", "_l", documents), "_t", "_l"), counts)


def identify(docs: DataFrame, model: tuple[ByteConv | None, list[str]], text: str = "text",
             keep: list[str] | None = None, least: float | None = None) -> DataFrame:
    """Columns to keep, lang_pred and score of every row.

    With ``least`` only rows of a known language with that score are given, the
    others being left out in the task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(texts):
        net, names = shared.value
        found, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        read = [i for i, t in enumerate(texts) if net is not None and t is not None and any(map(str.isalpha, t))]
        if read:
            p = softmax(net.text_scores([texts[i].encode() for i in read]))
            for i, row in zip(read, p):
                k = int(row.argmax())
                found[i], score[i] = names[k], float(row[k])
        stay = None if least is None else [f != UNKNOWN and s >= least for f, s in zip(found, score)]
        return [pa.array(found, pa.string()), pa.array(score, pa.float64())], stay

    keep = docs.columns if keep is None else keep
    return judged(docs, keep, text, [("lang_pred", "string"), ("score", "double")], judge)
