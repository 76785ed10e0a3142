"""Case featurizer: closed vocabularies, residual tf-idf, demographics.

``fit_features`` runs a handful of aggregations over the training cases and
returns a small model: three top-k vocabularies, at most ``tfidf_terms``
tf-idf terms with their idf, and two medians — all bounded by
configuration.  ``transform_features`` is then a narrow pass: the
vocabularies become literal arrays, a row's terms and residual tokens their
positions in them, and flags, term counts and the L2 norm are filled in
batch by batch — no join and no shuffle, whatever the number of cases.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as X
from ..session import written
from .labels import term_frequency, topk_terms

# Vocabulary sizes, tf-idf settings, defaults and feature names.
TOP_DRUGS = 90
TOP_INDICATIONS = 50
TOP_OTHER = 40
TFIDF_TERMS = 40
TFIDF_MIN_DF = 5
TOKEN_PATTERN = r"[a-z][a-z0-9]+"
UNKNOWN = "unknown"
AGE_DEFAULT = 50.0
WEIGHT_DEFAULT = 70.0
STRUCT_FEATURES = ["age_norm", "weight_norm", "sex_M", "sex_F", "age_lt30", "age_30_60", "age_gt60", "no_other_drugs"]


@dataclass
class FeatureModel:
    drug_vocab: list[str] = field(default_factory=list)
    indi_vocab: list[str] = field(default_factory=list)
    other_vocab: list[str] = field(default_factory=list)
    tfidf_terms: list[str] = field(default_factory=list)  # alphabetical
    tfidf_idf: list[float] = field(default_factory=list)
    age_median: float = AGE_DEFAULT
    weight_median: float = WEIGHT_DEFAULT

    @property
    def feature_names(self) -> list[str]:
        """drug_*, indi_*, other_*, tf_*, then the 8 demographic names."""
        return ([f"drug_{t}" for t in self.drug_vocab] + [f"indi_{t}" for t in self.indi_vocab]
                + [f"other_{t}" for t in self.other_vocab] + [f"tf_{t}" for t in self.tfidf_terms] + STRUCT_FEATURES)

    @property
    def dim(self) -> int:
        return len(self.feature_names)

    def to_tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """(vocabulary table, params table) — small tables, no pickles."""
        rows = ([("drug", t, i, None) for i, t in enumerate(self.drug_vocab)]
                + [("indi", t, i, None) for i, t in enumerate(self.indi_vocab)]
                + [("other", t, i, None) for i, t in enumerate(self.other_vocab)]
                + [("tf", t, i, float(v)) for i, (t, v) in enumerate(zip(self.tfidf_terms, self.tfidf_idf))])
        vocab = spark.createDataFrame(rows, "block string, term string, pos int, idf double")
        params = spark.createDataFrame([(self.age_median, self.weight_median)], "age_median double, weight_median double")
        return vocab, params

    @classmethod
    def from_tables(cls, vocab: DataFrame, params: DataFrame) -> FeatureModel:
        v = vocab.orderBy("block", "pos").collect()  # bounded by the vocabulary sizes
        p = params.first()
        pick = lambda b: [r["term"] for r in v if r["block"] == b]
        return cls(pick("drug"), pick("indi"), pick("other"), pick("tf"),
                   [r["idf"] for r in v if r["block"] == "tf"], p["age_median"], p["weight_median"])


def norm_terms(arr: Column) -> Column:
    """P9 on an array column: trim + upper each term, drop blanks; null -> []."""
    a = F.coalesce(arr, F.array().cast("array<string>"))
    return F.filter(F.transform(a, lambda t: F.upper(X.strip_ws(t))), lambda t: F.length(t) > 0)


def _lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def residual_tokens(drug: Column, other: Column, indi: Column, model: FeatureModel) -> Column:
    """Terms outside the closed vocabularies, lower-cased, in list order.
    (A filter per list, not a set difference, so repeated terms keep their count.)"""
    return _residual(norm_terms(drug), norm_terms(other), norm_terms(indi), model)


def _residual(drug: Column, other: Column, indi: Column, model: FeatureModel) -> Column:
    """``residual_tokens`` of lists of normalised terms."""
    dv, ov, iv = _lit_array(model.drug_vocab), _lit_array(model.other_vocab), _lit_array(model.indi_vocab)
    keep = lambda terms, voc: F.transform(F.filter(terms, lambda t: ~F.array_contains(voc, t)), F.lower)
    return F.concat(keep(drug, dv), keep(other, ov), keep(indi, iv))


def _as_text(tokens: Column) -> Column:
    # the terms are joined once, not again in a branch
    return F.filter(F.array(F.array_join(tokens, " "), F.lit(UNKNOWN)), lambda t: F.length(t) > 0)[0]


def residual_text(drug: Column, other: Column, indi: Column, model: FeatureModel) -> Column:
    """Space-joined residual terms, or the word ``unknown``."""
    return _as_text(residual_tokens(drug, other, indi, model))


def text_tokens(text: Column) -> Column:
    """M3 tokenizer: every match of [a-z][a-z0-9]+ in the text."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)


def fit_tfidf(docs: DataFrame, text: str = "text", key: str = "doc_id", min_df: int = TFIDF_MIN_DF,
              max_terms: int = TFIDF_TERMS) -> tuple[list[str], list[float]]:
    """M3 fit + A5: terms with df >= min_df, the max_terms with the highest corpus
    frequency (ties by term), idf = ln((1+n)/(1+df)) + 1; returned alphabetically."""
    n = docs.count()
    # One pass and one count by term, of tokens and of those that are the document's first of the term: only the vocabulary is
    # shuffled.  The outer explode keeps the optimizer from evaluating the tokens a second time in a filter on their number.
    tokens = docs.select(text_tokens(F.col(text)).alias("ts")).select("ts", F.posexplode_outer("ts").alias("at", "term")).where("term IS NOT NULL")
    first = F.array_position("ts", F.col("term")) == F.col("at") + 1
    st = tokens.groupBy("term").agg(F.count("*").alias("ctf"), F.count_if(first).alias("df")).where(F.col("df") >= min_df)
    top = st.orderBy(F.desc("ctf"), "term").limit(max_terms).collect()  # at most max_terms rows
    top = sorted(top, key=lambda r: r["term"])
    return [r["term"] for r in top], [math.log((1 + n) / (1 + r["df"])) + 1.0 for r in top]


def tfidf_vector(text: Column, terms: list[str], idf: list[float]) -> Column:
    """M3 transform: raw counts x idf, L2-normalised (all zeros stay zeros).

    Array expressions on the row: the text is tokenised once, tokens outside the fitted terms (at most ``TFIDF_TERMS``)
    are dropped, and what is left is counted for each term; no shuffle and no Python.
    """
    if not terms:
        return F.array().cast("array<double>")
    known = _lit_array(terms)
    weights = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(float(w)).alias("w")) for t, w in zip(terms, idf)])
    tokens = F.filter(text_tokens(F.coalesce(text, F.lit(""))), lambda t: F.array_contains(known, t))
    counted = lambda ts: F.transform(weights, lambda k: F.size(F.filter(ts, lambda t: t == k["t"])) * k["w"])
    norm = lambda xs: F.sqrt(F.aggregate(xs, F.lit(0.0), lambda a, x: a + x * x))
    unit = lambda xs, n: F.transform(xs, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))
    # each array is bound once: tokens, weighted counts, their norm
    return F.transform(F.array(tokens), lambda ts: F.transform(F.array(counted(ts)), lambda xs: F.transform(F.array(norm(xs)), lambda n: unit(xs, n))[0])[0])[0]


MEDIAN_BUCKETS = 1024


def exact_median(df: DataFrame, col: str) -> float | None:
    """Interpolated median of the finite values; None when there are none.

    Each pass counts the values between two bounds in MEDIAN_BUCKETS equal buckets and goes on inside the bucket of the
    middle: sums over the data, whatever its size, and no task sees the distinct values of another.
    """
    x = F.col(col).cast("double")
    values = df.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))).select(x.alias("x"))
    n, lo, hi = values.agg(F.count("*"), F.min("x"), F.max("x")).first()
    if not n:
        return None
    low, high, before = (n - 1) // 2, n // 2, 0
    while lo < hi:
        bucket = F.least(F.lit(MEDIAN_BUCKETS - 1), F.floor((F.col("x") - lo) / (hi - lo) * MEDIAN_BUCKETS))
        rows = values.where(F.col("x").between(lo, hi)).groupBy(bucket.alias("b")).agg(F.count("*").alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        ends = []  # of the buckets that hold the two middle ranks
        at = before
        for r in sorted(rows.collect()):  # at most MEDIAN_BUCKETS rows
            ends += [(r, at) for rank in (low, high) if at <= rank < at + r["c"]]
            at += r["c"]
        (a, start), (b, _) = ends
        if a["b"] != b["b"]:  # the last value of one bucket and the first of the next
            return (a["hi"] + b["lo"]) / 2
        lo, hi, before = a["lo"], a["hi"], start
    return float(lo)


def medians(df: DataFrame) -> tuple[float, float]:
    """A4: medians of age and weight; 50 / 70 when there is none.  Every pass reads the two columns as written once: ``df``
    may be a whole case assembly."""
    values = written(df.select("age_years", "weight_kg"), "medians")
    age, weight = exact_median(values, "age_years"), exact_median(values, "weight_kg")
    return AGE_DEFAULT if age is None else age, WEIGHT_DEFAULT if weight is None else weight


def fit_features(train: DataFrame, top_drugs: int = TOP_DRUGS, top_indi: int = TOP_INDICATIONS,
                 top_other: int = TOP_OTHER, tfidf_terms: int = TFIDF_TERMS, min_df: int = TFIDF_MIN_DF,
                 key: str = "primaryid") -> FeatureModel:
    """M1: learn the vocabularies, the residual tf-idf and the medians on train."""
    def vocab(col: str, k: int) -> list[str]:
        # counted as they are spelt, then only the different ones are normalised
        spelt = term_frequency(train, col, "_t").select(F.upper(X.strip_ws("_t")).alias("term"), "n").where(F.length("term") > 0)
        return [r["term"] for r in topk_terms(spelt.groupBy("term").agg(F.sum("n").alias("n")), k).orderBy("pos").collect()]

    m = FeatureModel(vocab("drug", top_drugs), vocab("indications", top_indi), vocab("other_drugs", top_other))
    docs = train.select(key, residual_text(F.col("drug"), F.col("other_drugs"), F.col("indications"), m).alias("text"))
    m.tfidf_terms, m.tfidf_idf = fit_tfidf(docs, "text", key, min_df, tfidf_terms)
    m.age_median, m.weight_median = medians(train)
    return m


def demographics(model: FeatureModel) -> list[Column]:
    """The 8 demographic features; missing age / weight -> train medians."""
    a = F.coalesce(F.col("age_years"), F.lit(model.age_median))
    w = F.coalesce(F.col("weight_kg"), F.lit(model.weight_median))
    s = F.upper(X.strip_ws(F.coalesce(F.col("sex"), F.lit(""))))
    b = lambda c: c.cast("double")
    return [a / 100.0, w / 100.0, b(s == "M"), b(s == "F"), b(a < 30), b((a >= 30) & (a <= 60)), b(a > 60),
            b(F.size(norm_terms(F.col("other_drugs"))) == 0)]


def multi_hot(arr: Column, vocab: list[str]) -> Column:
    """M2: one flag per vocabulary term; the terms are normalised once a row."""
    if not vocab:
        return F.array().cast("array<double>")
    flags = lambda toks: F.transform(_lit_array(vocab), lambda t: F.array_contains(toks, t).cast("double"))
    return F.transform(F.array(norm_terms(arr)), flags)[0]


def places(terms: Column, vocab: list[str]) -> Column:
    """Positions (from 0) in ``vocab`` of those ``terms`` that it has, repeated terms repeated."""
    found = F.transform(terms, lambda t: F.array_position(_lit_array(vocab), t).cast("int") - 1)
    return F.filter(found, lambda p: p >= 0)


def _cells(col, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of an Arrow list column of ``n`` rows."""
    lengths = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(n), lengths), col.flatten().to_numpy(zero_copy_only=False)


def _unit_counts(col, n: int, idf: np.ndarray) -> np.ndarray:
    """(n, terms) matrix of counts x idf from a list column of term positions, L2-normalised."""
    rows, at = _cells(col, n)
    x = np.bincount(rows * len(idf) + at, minlength=n * len(idf)).reshape(n, len(idf)) * idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _list_array(x: np.ndarray):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def with_tfidf(df: DataFrame, text: Column, terms: list[str], idf: list[float], out: str, keep: list[str]) -> DataFrame:
    """M3 transform: ``keep`` and ``out``, the vector of ``tfidf_vector``; positions are found in the row, counted by batch."""
    weights, schema = np.array(idf, dtype=np.float64), T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches):
        import pyarrow as pa

        for rb in batches:
            vectors = _unit_counts(rb.column(len(keep)), rb.num_rows, weights)
            yield pa.RecordBatch.from_arrays([*rb.columns[:len(keep)], _list_array(vectors)], names=[*keep, out])

    return df.select(*keep, places(text_tokens(F.coalesce(text, F.lit(""))), terms).alias("_tf")).mapInArrow(run, schema)


def located(df: DataFrame, model: FeatureModel, keep: list[str]) -> DataFrame:
    """``keep`` and, of each row, the positions of its terms and residual tokens in the vocabularies and its demographics:
    what ``filled`` makes the wide row from."""
    blocks = [("drug", model.drug_vocab), ("indications", model.indi_vocab), ("other_drugs", model.other_vocab)]
    rows = df.withColumns({f"_{c}": norm_terms(F.col(c)) for c, _ in blocks})  # once a row, for flags and residual text
    resid = _as_text(_residual(F.col("_drug"), F.col("_other_drugs"), F.col("_indications"), model))
    hot = [places(F.col(f"_{c}"), vocab).alias(f"_at_{c}") for c, vocab in blocks]
    tokens = places(text_tokens(resid), model.tfidf_terms).alias("_tf")
    return rows.select(*keep, *hot, tokens, F.array(*demographics(model)).alias("_demo"))


def filled(columns: list, n: int, model: FeatureModel) -> np.ndarray:
    """(n, dim) matrix of the feature rows from the Arrow columns that ``located`` adds."""
    starts = np.cumsum([0, len(model.drug_vocab), len(model.indi_vocab), len(model.other_vocab)]).tolist()
    idf, lo = np.array(model.tfidf_idf, dtype=np.float64), starts[-1]
    x = np.zeros((n, model.dim))
    for k, start in enumerate(starts[:-1]):
        rows, at = _cells(columns[k], n)
        x[rows, start + at] = 1.0
    x[:, lo:lo + len(idf)] = _unit_counts(columns[3], n, idf)
    x[:, lo + len(idf):] = _cells(columns[4], n)[1].reshape(n, -1)
    return x


def transform_features(df: DataFrame, model: FeatureModel, out: str = "features") -> DataFrame:
    """M4: fixed-width row drug | indi | other | tf | 8 demographic (width = model.dim).

    A row's terms and tokens become positions in the vocabularies; the wide row is filled in for an Arrow batch at a time, since
    a flag or a count for each vocabulary term is as many interpreted expressions a row.
    """
    keep = [c for c in df.columns if c != out]

    def run(batches):
        import pyarrow as pa

        for rb in batches:
            x = filled(rb.columns[len(keep):], rb.num_rows, model)
            yield pa.RecordBatch.from_arrays([*rb.columns[:len(keep)], _list_array(x)], names=[*keep, out])

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(out, T.ArrayType(T.DoubleType()))])
    return located(df, model, keep).mapInArrow(run, schema)


def sparse_entries(df: DataFrame, key: str, features: str = "features") -> DataFrame:
    """Long (key, feature_id, value) of the non-zero entries (outer, so that the row is not computed again to filter empty ones)."""
    return df.select(key, F.posexplode_outer(features).alias("feature_id", "value")).where(F.col("value") != 0)
