"""The registered queries: one small plan per operator over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textforge.functions import cleaning as C
from textforge.functions import tokens as K
from textforge.functions.stopwords import STOP_WORDS, without_negations, word_table
from textforge.operators import evaluate as E
from textforge.operators import labels as L
from textforge.operators import neighbors as N
from textforge.operators import profile as P
from textforge.operators import resample as R
from textforge.operators import split as S
from textforge.operators import vectorize as V
from textforge.operators import words as W
from textforge.operators.models import DEFAULT_MODELS, fit_model, out_of_fold
from textforge.plans import flows
from textforge.session import materialize, scratch_path
from textforge.sources import sinks, text_files
from textforge.sources.tables import (
    documents_with_labels,
    labelled_documents,
    table,
    text_table,
    turns,
)
from textforge.streaming import scoring

VOCAB = V.VectorizerOptions("tfidf", 5000, (1, 2), STOP_WORDS)
COUNTS = V.VectorizerOptions("count", 5000, (1, 2), STOP_WORDS)
ENGLISH = V.VectorizerOptions("tfidf", 5000, (1, 2), "english")
BIGRAMS = V.VectorizerOptions("count", None, (1, 2))
COVERAGE_CAPS = flows.SWEEP_CAPS
# Emoticon, pictograph, transport, flag, dingbat and enclosed / CJK ranges, and a plain letter.
EMOJI_MARKS = ("😀", "🌍", "🚀", "🇩", "✂", "Ⓜ", "中", "가", "a")

REGISTRY: dict = {}


def query(name: str):
    def add(function):
        REGISTRY[name] = function
        return function

    return add


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return text_table(spark, folder, "documents", "doc_id", "text")


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return text_table(spark, folder, "pages")


def _linked_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages whose text holds their own url, on every other page."""
    url = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" see "), "url", F.lit(" there"))).otherwise("")
    return _pages(spark, folder).withColumn("html", F.concat("html", url))


def _emoji_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a character of one of the emoji ranges before and after the text."""
    marks = F.array(*(F.lit(c) for c in EMOJI_MARKS))
    mark = F.get(marks, (F.col("doc_id") % len(EMOJI_MARKS)).cast("int"))
    return _docs(spark, folder).withColumn("text", F.concat(mark, "text", mark, F.lit(" end")))


def _digest(tokens: Column) -> Column:
    return F.md5(F.array_join(tokens, "|"))


# Sources and sinks


@query("csv_roundtrip")
def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "documents.csv")
    docs = text_table(spark, folder, "documents", "doc_id", "text", "lang")
    sinks.write_processed(docs, path, "csv")
    schema = "doc_id bigint, text string, lang string"
    back = text_files.load_labelled(spark, f"{path}/*.csv", "text", "lang", schema=schema)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("lines_source")
def lines_source(spark, folder):
    path = scratch_path(spark, "lines")
    _docs(spark, folder).select("text").write.text(path)
    lines = text_files.read_lines(spark, path)
    return lines.groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def _label_report(spark, folder) -> DataFrame:
    return E.classification_report(table(spark, folder, "labels"), "quality", "toxic")


@query("folder_roundtrip")
def folder_roundtrip(spark, folder):
    path = scratch_path(spark, "folder")
    docs = text_table(spark, folder, "documents", "doc_id", "text", "lang")
    docs.write.mode("overwrite").options(**text_files.CSV_OPTIONS).csv(path)
    back = text_files.read_csv_folder(spark, path, schema="doc_id bigint, text string, lang string")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("features_roundtrip")
def features_roundtrip(spark, folder):
    path = scratch_path(spark, "features")
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    sinks.write_features(S.stratified_split(labels, "doc_id", "label"), path)
    return spark.read.parquet(path).select("doc_id", "label", "split")


@query("report_roundtrip")
def report_roundtrip(spark, folder):
    path = scratch_path(spark, "reports")
    report = E.classification_report(_flag_predictions(spark, folder), "actual", "predicted", "model")
    sinks.write_report(report, path)
    return _rounded(spark.read.parquet(path), "model", "label")


@query("model_roundtrip")
def model_roundtrip(spark, folder):
    """Rows that a saved and loaded classifier scores as the fitted one does."""
    path = scratch_path(spark, "classifier")
    fitted = _classifier(spark, folder)
    fitted.save(spark, path)
    stored = flows.TextClassifier.load(spark, path)
    before = fitted.score(turns(spark, folder)).select("key", F.col("predicted_label").alias("before"))
    after = stored.score(turns(spark, folder)).select("key", "label", "predicted_label")
    same = (F.col("before") == F.col("predicted_label")).alias("same")
    return after.join(before, "key").select("key", "label", same)


@query("metrics_long")
def metrics_long(spark, folder):
    return sinks.report_metrics(_label_report(spark, folder)).select("metric", F.round("value", 6).alias("value"))


# Projections and filters


@query("null_text_policy")
def null_text_policy(spark, folder):
    df = documents_with_labels(spark, folder)
    return df.select(
        "doc_id",
        C.fill_null_text(F.col("label"), "nan").alias("as_word"),
        C.fill_null_text(F.col("label")).alias("as_empty"),
    )


@query("null_rows")
def null_rows(spark, folder):
    return P.null_rows(documents_with_labels(spark, folder), "label").select("doc_id")


@query("dropna_any")
def dropna_any(spark, folder):
    kept = P.drop_null_rows(documents_with_labels(spark, folder))
    return kept.select("doc_id", "label", F.char_length("text").alias("n_chars"))


@query("blank_filter")
def blank_filter(spark, folder):
    digits = _docs(spark, folder).withColumn("text", F.regexp_replace("text", r"[^0-9\s]", ""))
    return P.non_blank_rows(digits, "text").select("doc_id", "text")


def _sentences(spark, folder) -> DataFrame:
    parts = F.split("text", r"\.")
    return K.explode_terms(_docs(spark, folder), parts, "doc_id", name="text", position=True)


@query("edge_space_rows")
def edge_space_rows(spark, folder):
    rows = _sentences(spark, folder).filter(P.has_edge_space(F.col("text")))
    return rows.select("doc_id", "pos", F.char_length("text").alias("n_chars"))


@query("url_rows")
def url_rows(spark, folder):
    return _linked_pages(spark, folder).filter(P.has_url(F.col("html"))).select("page_id")


@query("newline_rows")
def newline_rows(spark, folder):
    return _docs(spark, folder).filter(P.has_newline(F.col("text"))).select("doc_id")


@query("empty_after_clean")
def empty_after_clean(spark, folder):
    cleaned = C.with_clean(_sentences(spark, folder), "text")
    return cleaned.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("cleaned") == "").alias("empty")
    )


@query("head_n")
def head_n(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return P.head_rows(docs, "doc_id", 5)


@query("sample_n")
def sample_n(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return P.sample_rows(docs, "doc_id", 6)


# Words


def _words(spark, folder) -> DataFrame:
    return K.explode_terms(_docs(spark, folder), K.ws_tokens(F.lower("text")))


@query("top_words_by_label")
def top_words_by_label(spark, folder):
    df = labelled_documents(spark, folder).withColumn("text", F.lower("text"))
    return W.top_words_by_label(df, "text", "label", 20)


@query("tokens_no_stop")
def tokens_no_stop(spark, folder):
    words = W.without_words(_words(spark, folder), word_table(spark, STOP_WORDS))
    return W.word_freq(words)


@query("top_stopwords")
def top_stopwords(spark, folder):
    words = W.only_words(_words(spark, folder), word_table(spark, STOP_WORDS))
    return W.top_words(W.word_freq(words), 25).select("word", "n")


@query("stopword_except")
def stopword_except(spark, folder):
    kept = without_negations(word_table(spark, STOP_WORDS))
    return W.only_words(_words(spark, folder), kept).select("word").distinct()


@query("word_freq")
def word_freq(spark, folder):
    return W.word_freq(_words(spark, folder))


@query("term_weights")
def term_weights(spark, folder):
    weights = W.term_weights(W.word_freq(_words(spark, folder)))
    return weights.select("word", "n", F.round("weight", 6).alias("weight"))


@query("top_words_slice")
def top_words_slice(spark, folder):
    return W.top_words(W.word_freq(_words(spark, folder)), 20, start=10)


@query("char_freq")
def char_freq(spark, folder):
    return W.char_freq(_docs(spark, folder), "text", joined=True).orderBy("freq", "char")


@query("lemma_join")
def lemma_join(spark, folder):
    df = turns(spark, folder).select("key", K.term_tokens(F.col("text")).alias("tokens"))
    words = K.explode_terms(df, "tokens")
    lemmas = materialize(W.lemma_table(words, words), "lemmas")
    out = W.lemmatize(df, "key", "tokens", lemmas)
    return out.select("key", F.array_join("tokens", " ").alias("text"))


# Profile


@query("data_stats")
def data_stats(spark, folder):
    return P.data_stats(documents_with_labels(spark, folder), "text", "label")


@query("missing_by_column")
def missing_by_column(spark, folder):
    return P.missing_by_column(documents_with_labels(spark, folder))


@query("distinct_labels")
def distinct_labels(spark, folder):
    return P.distinct_labels(documents_with_labels(spark, folder), "label")


@query("n_classes")
def n_classes(spark, folder):
    return P.n_classes(table(spark, folder, "lineitem"), "l_returnflag")


@query("label_counts")
def label_counts(spark, folder):
    return P.label_counts(table(spark, folder, "lineitem"), "l_returnflag")


@query("label_distribution")
def label_distribution(spark, folder):
    shares = P.label_shares(documents_with_labels(spark, folder), "label")
    return shares.select("label", F.round("share", 6).alias("share"))


@query("label_pct")
def label_pct(spark, folder):
    shares = P.label_shares(table(spark, folder, "lineitem"), "l_returnflag")
    return shares.select("label", F.round(F.col("share") * 100, 2).alias("pct"))


@query("label_share_by_split")
def label_share_by_split(spark, folder):
    parted = S.stratified_split(table(spark, folder, "labels"), "doc_id", "quality")
    shares = P.label_shares(parted, "quality", "split")
    return shares.select("split", "label", "n", F.round("share", 6).alias("share"))


@query("duplicate_count")
def duplicate_count(spark, folder):
    docs = text_table(spark, folder, "documents", "doc_id", "text", "lang")
    return P.duplicate_count(docs, "text", "lang")


@query("dedup_rows")
def dedup_rows(spark, folder):
    docs = text_table(spark, folder, "documents", "doc_id", "text", "lang")
    kept = P.drop_duplicate_rows(docs, "doc_id", "text", "lang")
    return kept.select("doc_id", "lang", F.md5("text").alias("text_md5"))


@query("duplicate_rows")
def duplicate_rows(spark, folder):
    docs = text_table(spark, folder, "documents", "doc_id", "text", "lang")
    return P.duplicate_rows(docs, "doc_id", "text", "lang").select("doc_id", "lang")


@query("column_profile")
def column_profile(spark, folder):
    return P.column_profile(documents_with_labels(spark, folder))


@query("word_count_summary")
def word_count_summary(spark, folder):
    docs = _docs(spark, folder).select(F.size(K.ws_tokens(F.col("text"))).alias("word_count"))
    return P.numeric_summary(docs, "word_count")


@query("big_value_summary")
def big_value_summary(spark, folder):
    orders = table(spark, folder, "orders").select((F.col("o_orderkey") + 1_000_000_000).alias("x"))
    return P.numeric_summary(orders, "x")


@query("length_hist_by_label")
def length_hist_by_label(spark, folder):
    docs = labelled_documents(spark, folder)
    counted = docs.select("label", F.size(K.ws_tokens(F.col("text"))).alias("word_count"))
    return P.histogram(counted, "word_count", 50, "label")


@query("length_density_by_label")
def length_density_by_label(spark, folder):
    docs = labelled_documents(spark, folder)
    counted = docs.select("label", F.size(K.ws_tokens(F.col("text"))).alias("word_count"))
    curve = P.density(counted, "word_count", "label")
    return curve.select("label", "point", F.round("x", 4).alias("x"), F.round("density", 6).alias("density"))


# Cleaners


def _on_documents(step):
    return lambda spark, folder: _docs(spark, folder).select("doc_id", step(F.col("text")).alias("text"))


def _on_pages(step):
    return lambda spark, folder: _pages(spark, folder).select("page_id", step(F.col("html")).alias("text"))


REGISTRY["strip_tags"] = _on_pages(C.strip_tags)
REGISTRY["unescape_basic"] = _on_pages(C.unescape)
REGISTRY["strip_urls"] = lambda spark, folder: _linked_pages(spark, folder).select(
    "page_id", C.strip_urls(F.col("html")).alias("text")
)
REGISTRY["strip_punct"] = _on_documents(C.strip_punctuation)
REGISTRY["strip_digits"] = _on_documents(C.strip_digits)
REGISTRY["strip_emoji"] = lambda spark, folder: _emoji_docs(spark, folder).select(
    "doc_id", C.strip_emoji(F.col("text")).alias("text")
)


def _all_texts(spark, folder) -> DataFrame:
    docs = _emoji_docs(spark, folder).select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"), "text"
    )
    pages = _linked_pages(spark, folder).select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("key"),
        F.col("html").alias("text"),
    )
    return docs.unionByName(pages)


def _cleaned(opts):
    return lambda spark, folder: C.with_clean(_all_texts(spark, folder), "text", opts=opts).select(
        "key", "cleaned"
    )


REGISTRY["clean_text_full"] = _cleaned(C.FULL)
REGISTRY["clean_text_default"] = _cleaned(C.DEFAULT)
REGISTRY["clean_text_light"] = _cleaned(C.LIGHT)


@query("tokens_ws")
def tokens_ws(spark, folder):
    df = _docs(spark, folder).select("doc_id", K.ws_tokens(F.col("text")).alias("t"))
    return df.select("doc_id", F.size("t").alias("n"), _digest(F.col("t")).alias("digest"))


@query("vec_tokens")
def vec_tokens(spark, folder):
    tokens = K.term_tokens(F.col("text"), STOP_WORDS)
    df = _docs(spark, folder).select("doc_id", tokens.alias("t"))
    return df.select("doc_id", F.size("t").alias("n"), _digest(F.col("t")).alias("digest"))


@query("ngrams_12")
def ngrams_12(spark, folder):
    df = V.terms_of(_docs(spark, folder), "text", VOCAB, "t")
    return df.select("doc_id", F.size("t").alias("n"), _digest(F.col("t")).alias("digest"))


@query("text_features")
def text_features(spark, folder):
    features = K.text_features(F.col("text"), STOP_WORDS)
    return _docs(spark, folder).select("doc_id", *(c.alias(n) for n, c in features.items()))


@query("notebook_clean")
def notebook_clean(spark, folder):
    df = flows.notebook_clean(documents_with_labels(spark, folder), "doc_id", "text", STOP_WORDS)
    return df.select("doc_id", "label", "cleaned")


# Vectors


@query("vocab_stats")
def vocab_stats(spark, folder):
    return V.term_stats(V.document_terms(_docs(spark, folder), "doc_id", "text", BIGRAMS))


@query("vocab_topn")
def vocab_topn(spark, folder):
    stats = V.term_stats(V.document_terms(_docs(spark, folder), "doc_id", "text", BIGRAMS))
    return V.vocabulary(stats, VOCAB.max_features)


@query("vocab_sweep")
def vocab_sweep(spark, folder):
    stats = V.term_stats(V.document_terms(_docs(spark, folder), "doc_id", "text", BIGRAMS))
    cover = V.vocabulary_coverage(materialize(stats, "term-stats"), COVERAGE_CAPS)
    return cover.select(
        "max_features", "terms", "occurrences", F.round("coverage", 6).alias("coverage")
    )


@query("count_vectors")
def count_vectors(spark, folder):
    docs = _docs(spark, folder)
    _, rows = V.fit_transform(docs, "text", COUNTS)
    entries = V.vector_entries(rows, "doc_id")
    return entries.select("doc_id", "idx", F.col("value").cast("int").alias("tf"))


def _tfidf(opts):
    def run(spark, folder):
        _, rows = V.fit_transform(_docs(spark, folder), "text", opts)
        entries = V.vector_entries(rows, "doc_id")
        return entries.select("doc_id", "idx", F.round("value", 6).alias("weight"))

    return run


REGISTRY["tfidf"] = _tfidf(VOCAB)
REGISTRY["tfidf_english"] = _tfidf(ENGLISH)


@query("tfidf_by_join")
def tfidf_by_join(spark, folder):
    weights = V.tfidf_table(_docs(spark, folder), "doc_id", "text", VOCAB)
    return weights.select("doc_id", "term", "idx", "tf", F.round("weight", 6).alias("weight"))


@query("tfidf_transform")
def tfidf_transform(spark, folder):
    fitted = V.fit_vectorizer(_docs(spark, folder), "text", VOCAB)
    entries = V.vector_entries(fitted.transform(turns(spark, folder)), "key")
    return entries.select("key", "idx", F.round("value", 6).alias("weight"))


@query("label_encode")
def label_encode(spark, folder):
    coded, _ = L.encode_labels(turns(spark, folder).select("key", "label"), "label")
    return coded


@query("label_decode")
def label_decode(spark, folder):
    coded, classes = L.encode_labels(turns(spark, folder).select("key", "label"), "label")
    return L.decode_labels(coded.select("key", "code"), "code", classes)


@query("processed_table")
def processed_table(spark, folder):
    out, _ = flows.processed_table(labelled_documents(spark, folder), "doc_id", "text", "label")
    return out.withColumn("original_text", F.md5("original_text"))


# Splits


@query("split_random")
def split_random(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return S.random_split(docs, "doc_id")


@query("split_bucket")
def split_bucket(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return S.random_split(docs, "doc_id", exact=False)


@query("split_stratified")
def split_stratified(spark, folder):
    rows = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return S.stratified_split(rows, "doc_id", "label")


@query("kfold_assign")
def kfold_assign(spark, folder):
    rows = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return S.kfold(rows, "doc_id", "label", 5)


@query("undersample")
def undersample(spark, folder):
    rows = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return S.undersample(rows, "doc_id", "label")


@query("class_weights")
def class_weights(spark, folder):
    weights = S.class_weights(table(spark, folder, "labels"), "quality")
    return weights.select("label", "n", F.round("weight", 6).alias("weight"))


# Neighbours and resampling


def _vectors(spark, folder) -> DataFrame:
    """Embeddings with a two-class label, about 30 % in class 1."""
    return table(spark, folder, "embeddings").select(
        "vec_id", "embedding", (F.col("label") < 3).cast("int").alias("label")
    )


@query("knn_join")
def knn_join(spark, folder):
    vectors = table(spark, folder, "embeddings")
    near = N.knn_join(vectors, vectors, 5, key="vec_id", vec="embedding", exclude_self=True)
    return near.select("vec_id", "neighbor", "rank", F.round("d2", 6).alias("d2"))


@query("knn_classify")
def knn_classify(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return N.knn_classify(vectors, vectors, 5, key="vec_id", vec="embedding", exclude_self=True)


@query("knn_foreign")
def knn_foreign(spark, folder):
    """Queries that share their keys with unrelated base rows: the keys are shifted by 7."""
    base = table(spark, folder, "embeddings")
    queries = base.withColumn("vec_id", F.col("vec_id") + 7)
    near = N.knn_join(queries, base, 5, key="vec_id", vec="embedding")
    return near.select("vec_id", "neighbor", "rank", F.round("d2", 6).alias("d2"))


def _summed(df: DataFrame) -> DataFrame:
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)
    return df.select(
        "key",
        "label",
        "synthetic",
        F.round(total, 6).alias("x_sum"),
        F.round(F.get("embedding", F.lit(0)), 6).alias("x_first"),
    )


@query("smote")
def smote(spark, folder):
    return _summed(R.smote(_vectors(spark, folder), "vec_id", "embedding", "label"))


@query("adasyn_weights")
def adasyn_weights(spark, folder):
    weights = R.adasyn_weights(_vectors(spark, folder), "vec_id", "embedding", "label")
    return weights.withColumn("weight", F.round("weight", 9))


@query("adasyn")
def adasyn(spark, folder):
    return _summed(R.adasyn(_vectors(spark, folder), "vec_id", "embedding", "label"))


@query("enn_clean")
def enn_clean(spark, folder):
    kept = R.edited_neighbors(_vectors(spark, folder), "vec_id", "embedding", "label")
    return kept.select("vec_id", "label")


@query("smoteenn")
def smoteenn(spark, folder):
    return _summed(R.smoteenn(_vectors(spark, folder), "vec_id", "embedding", "label"))


# Evaluation

# Fixed rules that stand for three models: a class from the line number.
FLAG_RULES = {
    "m1": "CASE l_linenumber % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END",
    "m2": "CASE WHEN l_linenumber <= 4 THEN l_returnflag ELSE 'N' END",
    "m3": "CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag ELSE 'A' END",
}


def _flag_predictions(spark, folder) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_linenumber", "l_returnflag")
    rules = F.array(
        *(
            F.struct(F.lit(name).alias("model"), F.expr(rule).alias("predicted"))
            for name, rule in FLAG_RULES.items()
        )
    )
    return lines.select(F.col("l_returnflag").alias("actual"), F.inline(rules))


def _rounded(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *(F.col(c) if c in keep else F.round(c, 6).alias(c) for c in df.columns)
    )


@query("eval_metrics")
def eval_metrics(spark, folder):
    return _rounded(E.summary(table(spark, folder, "labels"), "quality", "toxic"))


@query("confusion_matrix")
def confusion_matrix(spark, folder):
    return E.confusion_matrix(table(spark, folder, "labels"), "quality", "toxic")


@query("classification_report")
def classification_report(spark, folder):
    report = E.classification_report(
        _flag_predictions(spark, folder), "actual", "predicted", "model"
    )
    return _rounded(report, "model", "label")


@query("compare_models")
def compare_models(spark, folder):
    scores = E.compare_models(_flag_predictions(spark, folder), "actual", "predicted")
    return _rounded(scores, "model")


@query("best_model")
def best_model(spark, folder):
    scores = E.summary(_flag_predictions(spark, folder), "actual", "predicted", "model")
    return _rounded(E.best_model(scores), "model")


# Models, with the default training configuration.

LOGISTIC, FOREST, BOOSTED, STACK = DEFAULT_MODELS


def _prepared(spark: SparkSession, folder: str) -> flows.Prepared:
    """Features of the conversation turns (three classes)."""
    return flows.prepare(turns(spark, folder), "key", "text", "label", vectorizer=VOCAB, stratify=True)


def _share_of_largest(prepared: flows.Prepared) -> Column:
    """The accuracy that naming the largest class gives on the test rows."""
    counts = prepared.test.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n") / F.sum("n")).scalar()


def _judged(scored: DataFrame, n_classes: int, *keep: str) -> DataFrame:
    """Key and class of scored rows, and what must hold for every prediction."""
    total = F.aggregate("probability", F.lit(0.0), lambda s, x: s + x)
    return scored.select(
        *keep,
        F.col("label").cast("int").alias("actual"),
        F.col("prediction").cast("int").between(0, n_classes - 1).alias("known_class"),
        (F.size("probability") == n_classes).alias("all_classes"),
        (F.abs(total - 1) < 1e-6).alias("sums_to_one"),
        (F.array_max("probability") >= 1 / n_classes - 1e-9).alias("confident"),
    )


def _predicted(spec):
    def run(spark, folder):
        prepared = _prepared(spark, folder)
        model = fit_model(prepared.train, spec, prepared.n_classes)
        return _judged(model.score(prepared.test), prepared.n_classes, "key")

    return run


REGISTRY["lr_predict"] = _predicted(LOGISTIC)
REGISTRY["rf_predict"] = _predicted(FOREST)
REGISTRY["gbt_predict"] = _predicted(BOOSTED)


@query("preprocess_flow")
def preprocess_flow(spark, folder):
    prepared = _prepared(spark, folder)
    entries = V.vector_entries(prepared.features, "key", "label", "split")
    return entries.withColumn("value", F.round("value", 6))


@query("stack_oof")
def stack_oof(spark, folder):
    prepared = _prepared(spark, folder)
    oof = out_of_fold(prepared.train, [LOGISTIC, FOREST], prepared.n_classes, 5)
    shares = F.unwrap_udt("features")["values"]
    total = F.aggregate(shares, F.lit(0.0), lambda s, x: s + x)
    return oof.select(
        "key", "label", "fold", F.size(shares).alias("n_shares"), (F.abs(total - 2) < 1e-6).alias("sums_to_two")
    )


@query("stack_variant")
def stack_variant(spark, folder):
    prepared = _prepared(spark, folder)
    model = flows.train_stack_variant(prepared)
    return _judged(model.score(prepared.test), prepared.n_classes, "key")


@query("train_all")
def train_all(spark, folder):
    prepared = _prepared(spark, folder)
    scores = flows.train_all(prepared).scores
    return scores.select("model", (F.col("accuracy") > _share_of_largest(prepared) / 2).alias("learned"))


@query("eval_model")
def eval_model(spark, folder):
    """The stored evaluation of a model against one made from its predictions row by row."""
    prepared = _prepared(spark, folder)
    model = fit_model(prepared.train, LOGISTIC, prepared.n_classes)
    stored = flows.evaluate_model(model, prepared.test, "logistic_regression")[0]
    rows = model.score(prepared.test).select((F.col("label") == F.col("prediction")).alias("right"))
    share = rows.agg(F.count_if("right") / F.count(F.lit(1))).scalar()
    return stored.select("model", "test_samples", (F.abs(F.col("accuracy") - share) < 1e-9).alias("agrees"))


def _classifier(spark, folder) -> flows.TextClassifier:
    prepared = _prepared(spark, folder)
    return flows.TextClassifier.of(prepared, fit_model(prepared.train, LOGISTIC, prepared.n_classes))


@query("score_batch")
def score_batch(spark, folder):
    classifier = _classifier(spark, folder)
    scored = classifier.score(turns(spark, folder))
    return scored.select("key", "label", F.col("predicted_label").isin(*classifier.names).alias("known"))


@query("sweep")
def sweep(spark, folder):
    prepared = _prepared(spark, folder)
    settings = flows.sweep_settings()
    scores = flows.sweep_vectorizers(prepared.cleaned, settings, n_classes=prepared.n_classes)
    return scores.select("model", F.col("accuracy").between(0, 1).alias("scored"))


@query("balance_sweep")
def balance_sweep(spark, folder):
    scores = flows.sweep_balancing(_prepared(spark, folder))
    return scores.select("model", F.coalesce(F.col("accuracy").between(0, 1), F.lit(True)).alias("scored"))


# Streams


def _stream(spark, folder, name) -> DataFrame:
    schema = table(spark, folder, name).schema
    return scoring.read_table_stream(spark, folder, f"{name}.parquet", schema)


def _drain(spark, stream) -> DataFrame:
    return scoring.run_stream(
        stream, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-checkpoint")
    )


@query("stream_clean")
def stream_clean(spark, folder):
    stream = scoring.clean_stream(_stream(spark, folder, "documents"))
    return _drain(spark, stream.select("doc_id", "cleaned"))


@query("stream_score")
def stream_score(spark, folder):
    stream = _stream(spark, folder, "conversations")
    classifier = _classifier(spark, folder)
    streamed = _drain(
        spark, scoring.score_stream(stream, classifier).select("conv_id", "turn", "role", "predicted_label")
    )
    batch = classifier.score(turns(spark, folder)).select("key", F.col("predicted_label").alias("batch"))
    key = F.concat_ws("-", "conv_id", "turn")
    both = streamed.withColumn("key", key).join(batch, "key", "left")
    same = F.coalesce(F.col("batch") == F.col("predicted_label"), F.lit(False))
    return both.select("conv_id", "turn", "role", same.alias("same_as_batch"))


