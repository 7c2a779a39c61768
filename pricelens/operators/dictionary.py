"""Feature dictionaries: index, one-hot, assemble and scale without a label on the driver.

A label dictionary is a table with one row per (column, label): its count, its
index (most frequent first, ties by name), its slot in the feature vector and
the factor that scales the slot.  It is built by one counting pass and one range
sort, and rows are joined to it.  The vocabulary may grow with
the data: what the driver holds is a few numbers per column.

Vectors come in two forms, as the learners need them: ``scaled_features``,
the sparse one-hot vector over every label (linear models), and
``indexed_features``, one number per column, text columns as nominal indexes (trees, which
otherwise keep a bin for each slot of each row).
"""

from __future__ import annotations

import json
import math
import os
from dataclasses import dataclass, replace

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ID, LABEL
from ..session import cut_lineage, ensure_checkpoint_dir, no_shuffle_files_left, release
from .clean import column_kinds
from .features import SCALED, with_row_id, with_split_key

INDEXED = "indexed_features"
LABELS_SCHEMA = "column_name string, pos int, label string, n bigint, idx bigint, slot bigint, scale double"
LABELS_DIR, SPEC_DIR = "labels", "spec"

#: A dictionary of one column is broadcast up to this size; a larger one is joined by a shuffle.
BROADCAST_LABELS, BROADCAST_BYTES = 500_000, 32 << 20
#: Labels on more than 1/HOT_SHARE of the training rows (fewer than HOT_SHARE a column) never go through that shuffle.
HOT_SHARE = 1_000
#: Nominal features keep this many labels, the most frequent, as MLlib by default has bins for a number; all others
#: count as unknown.  It bounds the statistics of a tree node and the label set that every split of a tree holds (with
#: thousands of labels, forests outgrow the driver); linear models have a slot for every label.  ``tree_labels=None`` keeps all labels.
TREE_LABELS = 32
#: Tables with vectors have a file for every so many rows, about 350 bytes each, or more files.
ROWS_A_FILE = 2_000_000


@dataclass
class FeatureModel:
    """A fitted dictionary: text columns in vector order, numeric columns after them."""

    labels: DataFrame                  # LABELS_SCHEMA
    categoricals: list[str]
    numerics: list[str]
    sizes: list[int]                   # labels per text column
    label_bytes: list[int]             # bytes of these labels
    numeric_std: list[float]           # sample standard deviation per numeric column
    n_rows: int                        # training rows
    tree_labels: int | None = TREE_LABELS  # labels kept by a nominal index, None for all

    @property
    def width(self) -> int:
        """Slots of the one-hot vector."""
        return sum(self.sizes) + len(self.numerics)

    @property
    def offsets(self) -> list[int]:
        """First slot of each text column."""
        return [sum(self.sizes[:i]) for i in range(len(self.sizes))]

    @property
    def arities(self) -> list[int]:
        """Values of each nominal index: the labels kept, and the unknown one after them.

        Tree learners need as many rows as values: where every row has a label of its own, so that no training row is unknown, the last shares its index.
        """
        if self.tree_labels is None:
            return [min(n, max(1, self.n_rows - 1)) + 1 for n in self.sizes]
        return [min(n, self.tree_labels, max(1, self.n_rows // 8)) + 1 for n in self.sizes]

    def names(self, form: str = INDEXED) -> DataFrame:
        """(idx, feature_name) of every place of a vector, as a table."""
        spark = self.labels.sparkSession
        if form == INDEXED:
            return spark.createDataFrame(list(enumerate(self.categoricals + self.numerics)), "idx bigint, feature_name string")
        own = spark.createDataFrame([(self.width - len(self.numerics) + j, c) for j, c in enumerate(self.numerics)] or [], "idx bigint, feature_name string")
        return self.labels.select(F.col("slot").alias("idx"), F.concat_ws("=", "column_name", "label").alias("feature_name")).unionByName(own)

    # --- joining rows to the dictionary -------------------------------------

    def with_slots(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a struct ``_slot_i`` (slot, scale, idx) for each text column; null for unknown labels and nulls."""
        for i, column in enumerate(self.categoricals):
            own = self.labels.where(F.col("pos") == i)
            entry = F.struct("slot", "scale", "idx")
            if self.sizes[i] <= BROADCAST_LABELS and self.label_bytes[i] <= BROADCAST_BYTES:
                d = own.select(F.col("label").alias("_label"), entry.alias(f"_slot_{i}"))
                rows = rows.join(F.broadcast(d), F.col(f"`{column}`") == F.col("_label"), "left").drop("_label")
            else:
                rows = self._joined_by_shuffle(rows, column, i, own, entry)
        return rows

    def _joined_by_shuffle(self, rows: DataFrame, column: str, i: int, own: DataFrame, entry: Column) -> DataFrame:
        """Hot labels by a broadcast of their few rows, all others by a shuffle in which rows already served are spread."""
        is_hot = F.col("n") * HOT_SHARE > self.n_rows
        hot = own.where(is_hot).select(F.col("label").alias("_hot_label"), entry.alias("_hot"))
        rest = own.where(~is_hot).select(F.col("label").alias("_label"), F.lit(0).alias("_done"), entry.alias("_rest"))
        rows = rows.join(F.broadcast(hot), F.col(f"`{column}`") == F.col("_hot_label"), "left").drop("_hot_label")
        served = F.col("_hot").isNotNull() | F.col(f"`{column}`").isNull()
        spread = F.pmod(F.monotonically_increasing_id(), F.lit(HOT_SHARE)).cast("string")
        rows = rows.withColumn("_key", F.when(served, spread).otherwise(F.col(f"`{column}`"))).withColumn("_flag", served.cast("int"))
        rows = rows.join(rest, (F.col("_key") == F.col("_label")) & (F.col("_flag") == F.col("_done")), "left")
        return rows.withColumn(f"_slot_{i}", F.coalesce("_hot", "_rest")).drop("_hot", "_rest", "_key", "_flag", "_label", "_done")

    def _triples(self, scaled: bool) -> Column:
        """Array of (idx, value) of the non-zero places of a row, ascending; ``with_slots`` comes first."""
        cells = [F.struct(F.col(f"_slot_{i}.slot").cast("int").alias("idx"), (F.col(f"_slot_{i}.scale") if scaled else F.when(F.col(f"_slot_{i}").isNotNull(), 1.0)).alias("value"))
                 for i in range(len(self.categoricals))]
        base = self.width - len(self.numerics)
        for j, (c, std) in enumerate(zip(self.numerics, self.numeric_std)):
            factor = (1.0 / std if std else 0.0) if scaled else 1.0
            cells.append(F.struct(F.lit(base + j).alias("idx"), (F.col(f"`{c}`").cast("double") * F.lit(factor)).alias("value")))
        return F.filter(F.array(*cells), lambda t: t["value"].isNotNull() & (t["value"] != 0.0))

    def triples(self, rows: DataFrame, scaled: bool = True, id_col: str = ID) -> DataFrame:
        """(id, idx, value): the non-zero places of every row's one-hot vector."""
        return self.with_slots(rows).select(id_col, F.explode(self._triples(scaled)).alias("t")).select(id_col, "t.idx", "t.value")

    def _sparse(self) -> Column:
        """The scaled vector in the form vectors are stored in."""
        t = self._triples(True)
        return F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(self.width).alias("size"), F.transform(t, lambda x: x["idx"]).alias("indices"),
                        F.transform(t, lambda x: x["value"]).alias("values"))

    def _dense(self) -> Column:
        """One number per column: the label's index, or the last one where it is unknown or beyond the labels kept."""
        cells = [F.least(F.coalesce(F.col(f"_slot_{i}.idx"), F.lit(a - 1)), F.lit(a - 1)).cast("double") for i, a in enumerate(self.arities)]
        cells += [F.col(f"`{c}`").cast("double") for c in self.numerics]
        no = lambda kind: F.lit(None).cast(kind)
        return F.struct(F.lit(1).cast("tinyint").alias("type"), no("int").alias("size"), no("array<int>").alias("indices"), F.array(*cells).alias("values"))

    def attributes(self) -> dict:
        """Column metadata that tells tree learners which places are nominal, and how many values they have."""
        k = len(self.categoricals)
        nominal = [{"idx": i, "name": c, "num_vals": a} for i, (c, a) in enumerate(zip(self.categoricals, self.arities))]
        numeric = [{"idx": k + j, "name": c} for j, c in enumerate(self.numerics)]
        kinds = {name: own for name, own in (("nominal", nominal), ("numeric", numeric)) if own}
        return {"ml_attr": {"attrs": kinds, "num_attrs": k + len(self.numerics)}}

    def transform(self, rows: DataFrame, keep=None, forms=(SCALED, INDEXED), partitions: int | None = None) -> DataFrame:
        """The columns in ``keep`` (all) and the vectors in ``forms``, as a table in the shared checkpoint folder.

        Vectors are stored in their own layout and read back as vectors, so they
        are never built dense or in Python.  A row with a null in a numeric
        column has no vector.  With ``partitions`` the rows are dealt
        by split_key into that many files, for fits that pass over them again and again.
        """
        spark = rows.sparkSession
        keep = [c for c in (rows.columns if keep is None else keep) if c in rows.columns]
        built, whole = {SCALED: self._sparse, INDEXED: self._dense}, self._whole()
        out = self.with_slots(rows).select(*keep, *[F.when(whole, built[f]()).alias(f) for f in forms])
        if partitions:
            out = out.repartition(partitions, "split_key")
        path = os.path.join(ensure_checkpoint_dir(spark), "tables", _new_name())
        with no_shuffle_files_left(spark):
            out.write.parquet(path)
        fields = [T.StructField(f.name, VectorUDT() if f.name in forms else f.dataType) for f in out.schema.fields]
        back = spark.read.schema(T.StructType(fields)).parquet(path)
        return back.withMetadata(INDEXED, self.attributes()) if INDEXED in forms else back

    def _whole(self) -> Column:
        whole = F.lit(True)
        for c in self.numerics:
            whole = whole & F.col(f"`{c}`").isNotNull()
        return whole

    # --- predicting, without a table in between ------------------------------

    def predict(self, rows: DataFrame, model) -> DataFrame:
        """``rows`` with ``prediction``: a narrow plan over the joins to the dictionary, nothing is written.

        A linear model is looked up: each label's entry carries its coefficient times its
        scale, and a prediction adds up one entry a column.  Any other model takes the nominal indexes.
        A row with a null in a numeric column has no prediction.
        """
        if model.getFeaturesCol() == INDEXED:
            # One pass for all rows: where a number is missing, a 0 stands in for the trees and the prediction is dropped.
            values = array_to_vector(F.transform(self._dense()["values"], lambda v: F.coalesce(v, F.lit(0.0))))
            own = self.with_slots(rows).select(*rows.columns, values.alias(INDEXED)).withMetadata(INDEXED, self.attributes())
            return model.transform(own).select(*rows.columns, F.when(self._whole(), F.col("prediction")).alias("prediction"))
        base = self.width - len(self.numerics)
        coefficients = model.coefficients.toArray().tolist()  # as MLlib holds them
        spark = self.labels.sparkSession
        weight = spark.createDataFrame(list(enumerate(coefficients[:base])), "slot bigint, weight double")
        entries = cut_lineage(self.labels.join(weight, "slot").withColumn("scale", F.col("scale") * F.col("weight")).select(*self.labels.columns))
        looked_up = replace(self, labels=entries).with_slots(rows)
        total = F.lit(float(model.intercept))
        for i in range(len(self.categoricals)):
            total = total + F.coalesce(F.col(f"_slot_{i}.scale"), F.lit(0.0))
        for j, (c, std) in enumerate(zip(self.numerics, self.numeric_std)):
            total = total + F.col(f"`{c}`").cast("double") * F.lit(coefficients[base + j] / std if std else 0.0)
        return looked_up.select(*rows.columns, total.alias("prediction"))

    # --- storing -------------------------------------------------------------

    def save(self, path: str) -> None:
        """The label table and one small JSON row, under ``path`` (overwritten)."""
        spark = self.labels.sparkSession
        spec = {"categoricals": self.categoricals, "numerics": self.numerics, "sizes": self.sizes, "label_bytes": self.label_bytes,
                "numeric_std": self.numeric_std, "n_rows": self.n_rows, "tree_labels": self.tree_labels}
        self.labels.write.mode("overwrite").parquet(os.path.join(path, LABELS_DIR))
        spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, SPEC_DIR))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureModel":
        spec = json.loads(spark.read.text(os.path.join(path, SPEC_DIR)).first()[0])
        return cls(spark.read.schema(LABELS_SCHEMA).parquet(os.path.join(path, LABELS_DIR)), **spec)


def _new_name() -> str:
    import uuid
    return uuid.uuid4().hex


def label_table(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, pos, label, n, idx, slot) of every label of the text ``columns``, as a written table; nulls have no label.

    Labels are counted in one pass with partial sums, then dealt by ranges of
    (column, count descending, label) and numbered: a label's slot is the number
    of labels before it, over all columns, from its place in its range and the
    sizes of the ranges before (one row a range); its index is the slot less its column's first.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("pos"), F.col(f"`{c}`").cast("string").alias("label")) for i, c in enumerate(columns)])
    counts = cut_lineage(rows.select(F.explode(cells).alias("c")).where("c.label is not null").groupBy("c.pos", "c.label").agg(F.count("*").alias("n")))
    order = ["pos", F.desc("n"), "label"]
    place = F.monotonically_increasing_id()  # the range in its upper 31 bits, the place in it in the lower 33
    ranked = cut_lineage(counts.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "pos", "label", "n", F.shiftright(place, 33).cast("int").alias("part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")))
    ranges = ranked.groupBy("part").agg(F.count("*").alias("size"))
    before = ranges.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    numbered = ranked.join(F.broadcast(before), "part").withColumn("slot", F.col("before") + F.col("place"))  # one row a range
    first = numbered.groupBy("pos").agg(F.min("slot").alias("first"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("pos") + 1)
    table = cut_lineage(numbered.join(F.broadcast(first), "pos").select(  # one row a column
        name.alias("column_name"), "pos", "label", "n", (F.col("slot") - F.col("first")).alias("idx"), "slot"))
    release(counts)
    release(ranked)
    return table


def fit_features(train: DataFrame, categoricals=None, numerics=None, exclude=(ID, "split_key", "fold")) -> FeatureModel:
    """Fit a dictionary on ``train``; by default over every text and numeric column of its schema but the label.

    A slot is 0 or 1, so its sample standard deviation follows from the label's
    count alone; that of numeric columns takes one aggregation.  A column that never varies is scaled by 0.
    """
    if categoricals is None or numerics is None:
        cats, nums = column_kinds(train, LABEL, exclude)
        categoricals, numerics = (cats if categoricals is None else categoricals), (nums if numerics is None else numerics)
    categoricals, numerics = list(categoricals), list(numerics)
    std = [F.stddev_samp(F.col(f"`{c}`").cast("double")).alias(f"s{j}") for j, c in enumerate(numerics)]
    stats = train.agg(F.count("*").alias("n"), *std).first()
    n_rows = stats["n"]
    spark = train.sparkSession
    if not categoricals:
        return FeatureModel(spark.createDataFrame([], LABELS_SCHEMA), [], numerics, [], [], _clean_std(stats, numerics), n_rows)
    table = label_table(train, categoricals)
    per = {r["pos"]: r for r in table.groupBy("pos").agg(F.count("*").alias("k"), F.sum(F.octet_length("label")).alias("bytes")).collect()}
    n = F.col("n").cast("double")
    scale = F.when((n > 0) & (n < n_rows), 1.0 / F.sqrt(n * (n_rows - n) / (float(n_rows) * max(n_rows - 1, 1)))).otherwise(0.0)
    sizes = [per[i]["k"] if i in per else 0 for i in range(len(categoricals))]
    label_bytes = [int(per[i]["bytes"]) if i in per else 0 for i in range(len(categoricals))]
    labels = table.withColumn("scale", scale)
    return FeatureModel(labels, categoricals, numerics, sizes, label_bytes, _clean_std(stats, numerics), n_rows)


def _clean_std(stats, numerics) -> list[float]:
    values = [stats[f"s{j}"] for j in range(len(numerics))]
    return [0.0 if v is None or math.isnan(v) else float(v) for v in values]


@dataclass
class PreparedFeatures:
    """Train and test tables with both vectors, and the fitted dictionary."""
    train: DataFrame
    test: DataFrame
    features: FeatureModel


def prepare_features(clean: DataFrame, train_tenths: int = 8, categoricals=None, numerics=None, folds: int | None = None,
                     partitions: int | None = None, forms=(SCALED, INDEXED), tree_labels: int | None = TREE_LABELS) -> PreparedFeatures:
    """Split by the row's hash, fit the dictionary on the training side, write both sides with their vectors (``forms``).

    The tables that fits pass over many times are dealt by split_key into
    ``partitions`` files (by default as many as the session's shuffles have), or
    one for every ROWS_A_FILE rows where these are more, so no layout of the input leaves them in a few tasks.
    """
    from ..functions.columns import fold_of, is_train
    spark = clean.sparkSession
    rows = with_split_key(with_row_id(clean))
    features = fit_features(rows.where(is_train(F.col("split_key"), train_tenths)), categoricals, numerics)
    features = replace(features, tree_labels=tree_labels)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if train_tenths:
        partitions = max(partitions, math.ceil(features.n_rows * 10 / train_tenths / ROWS_A_FILE))
    keep = [ID, LABEL, "split_key"]
    if folds:
        rows, keep = rows.withColumn("fold", fold_of(F.col("split_key"), folds)), [*keep, "fold"]
    table = features.transform(rows, keep, forms, partitions)
    side = is_train(F.col("split_key"), train_tenths)
    return PreparedFeatures(table.where(side), table.where(~side), features)
