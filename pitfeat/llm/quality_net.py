"""Document quality by a byte-level convolutional network.

Learned filters run over overlapping chunks that cover the whole document; each
chunk keeps the largest response of every filter, and the chunks' scores are
averaged into one probability that the document has label 1.

Training sees a bounded sample of labelled documents, as many of each label; the
probability is then set to the true share of the labels.

Defined cases: null and empty texts are scored as an empty chunk. With no
labelled row every score is 0.5. If only one label occurs, it has probability 1.
Repeated rows each get a row, conflicting labels of a document all count. Only
the text is looked at for a score; other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.llm.byteconv import ByteConv, softmax
from pitfeat.llm.text_classes import DOCUMENTS, class_counts, fitted, judged, sampled_windows, share_of_class

CUT = 0.3


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", documents: int = 2 * DOCUMENTS) -> tuple[ByteConv | None, list]:
    """Network and label values. Labels are sampled first, which bounds the side that is
    broadcast, then the rows they meet: an id may be that of any number of rows."""
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), F.col(label).cast("int").alias("_y"))
    counts = class_counts(marks.select("_y"), "_y")
    return fitted(sampled_windows(labelled_rows(docs, marks, key, text, documents), "_t", "_y"), counts, updates=900)


def labelled_rows(docs: DataFrame, marks: DataFrame, key: str, text: str, documents: int) -> DataFrame:
    """At most ``documents`` rows of each label: _k, _t, _y."""
    picked = F.broadcast(share_of_class(marks, "_k", "_y", documents))
    rows = docs.select(F.col(key).alias("_d"), F.col(text).alias("_t")).join(picked, F.col("_d") == F.col("_k"))
    return share_of_class(rows.drop("_d"), "_k", "_y", documents)


def score(docs: DataFrame, model: tuple[ByteConv | None, list], text: str = "text",
          keep: list[str] | None = None, only_good: bool = False) -> DataFrame:
    """Columns to keep, score and predicted of every row; ``only_good`` leaves out the others in the task."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(texts):
        net, values = shared.value
        good = [0.5] * len(texts)
        if net is not None and texts:
            p = softmax(net.text_scores([(t or "").encode() for t in texts]))
            good = p[:, values.index(1)].tolist() if 1 in values else [0.0] * len(texts)
        marks = [int(g >= CUT) for g in good]
        return [pa.array(good, pa.float64()), pa.array(marks, pa.int32())], [m == 1 for m in marks] if only_good else None

    keep = docs.columns if keep is None else keep
    return judged(docs, keep, text, [("score", "double"), ("predicted", "integer")], judge)
