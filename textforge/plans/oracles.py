"""DuckDB SQL with the same result as each registered query that SQL can express."""

from __future__ import annotations

# Literals on purpose, not the package's own constants: a wrong constant there must not pass here.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
TAG = r"<[^>]+>"
URL = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+|ftp://[^{SPACE}]+"
# Fixed values.
URL_PROFILE = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}"
    r"\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]+"
)
PUNCTUATION_CHARS = ".!?;\"'()[]{}-"
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours he him his himself she her hers herself it its "
    "itself they them their theirs themselves a an and if or because as until while of at by for with "
    "without after upon but not to is are was were be been being have has had having do does did doing "
    "will would shall should may might must the then than so too very just"
).split()
KEPT_NEGATIONS = "not no however but yet".split()
# Spark's English list, without the words that hold an apostrophe: tokens never do.
ENGLISH_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her "
    "hers herself it its itself they them their theirs themselves what which who whom this that these "
    "those am is are was were be been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where "
    "why how all any both each few more most other some such no nor not only own same so than too very s "
    "t can will just don should now cannot could ought would"
).split()
NOUN_ENDINGS = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)
FLAG_RULES = {
    "m1": "CASE l_linenumber % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END",
    "m2": "CASE WHEN l_linenumber <= 4 THEN l_returnflag ELSE 'N' END",
    "m3": "CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag ELSE 'A' END",
}
COVERAGE_CAPS = (1000, 2000, 3000, 4000, 5000, 6000, 7000, 8000, 9000, 10000)
MAX_TERMS = 5000


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


def _values(words) -> str:
    return "(VALUES " + ", ".join(f"({_q(w)})" for w in words) + ") AS s(word)"


def _cut(text: str, pattern: str, new: str = "") -> str:
    return f"regexp_replace({text}, {_q(pattern)}, {_q(new)}, 'g')"


STOP_LIST = _list(STOP_WORDS)
ENGLISH_LIST = _list(ENGLISH_WORDS)
KEPT_STOP_LIST = _list([w for w in STOP_WORDS if w not in KEPT_NEGATIONS])


def _unescape(text: str) -> str:
    # The entities that occur in the tables; the ampersand last.
    for name, char in (
        ("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&#39;", "'"),
        ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&"),
    ):
        text = f"replace({text}, {_q(name)}, {_q(char)})"
    return text


def _no_punct(text: str) -> str:
    return _cut(text, rf"[^{WORD}{SPACE}]")


def _no_digits(text: str) -> str:
    return _cut(text, r"\p{Nd}+")


def _squeeze(text: str) -> str:
    return f"trim({_cut(text, f'[{SPACE}]+', ' ')})"


def _matches(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {_q(pattern)})"


def _ws_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, {_q(f'[{SPACE}]+')}), lambda w: w <> '')"


def _drop_words(tokens: str, words: str) -> str:
    return f"list_filter({tokens}, lambda w: NOT list_contains({words}, w))"


def _term_tokens(text: str, stop: bool | str = False) -> str:
    tokens = _matches(f"lower({text})", f"[{WORD}]{{2,}}")
    return _drop_words(tokens, STOP_LIST if stop is True else stop) if stop else tokens


def _clean(text: str, full: bool = False, light: bool = False) -> str:
    out = f"coalesce({text}, '')"
    if full:
        out = _cut(out, TAG)
    if not light:
        out = _unescape(out)
    if full:
        out = _cut(out, URL)
    out = _no_digits(_no_punct(f"lower({out})"))
    if full:
        out = _cut(out, EMOJI)
        out = f"array_to_string({_drop_words(_matches(out, f'[{WORD}]+'), STOP_LIST)}, ' ')"
    return _squeeze(out)


DOCS = "SELECT d.doc_id, d.text, l.quality AS label FROM documents d LEFT JOIN labels l USING (doc_id)"
LABELLED = "SELECT d.doc_id, d.text, l.quality AS label FROM documents d JOIN labels l USING (doc_id)"
TURNS = "SELECT conv_id || '-' || turn AS key, text, role AS label FROM conversations"
EMOJI_TEXTS = """
    SELECT doc_id, mark || text || mark || ' end' AS text
    FROM (SELECT *, ['😀', '🌍', '🚀', '🇩', '✂', 'Ⓜ', '中', '가', 'a'][doc_id % 9 + 1] AS mark FROM documents)
"""
LINKED_PAGES = """
    SELECT page_id, html || CASE WHEN page_id % 2 = 0 THEN ' see ' || url || ' there' ELSE '' END AS html FROM pages
"""
ALL_TEXTS = f"""
    SELECT 'd' || doc_id AS key, text FROM ({EMOJI_TEXTS}) UNION ALL
    SELECT 'p' || page_id AS key, html AS text FROM ({LINKED_PAGES})
"""
WORDS = f"SELECT unnest({_ws_tokens('lower(text)')}) AS word FROM documents"
WORD_COUNTS = f"SELECT word, count(*) AS n FROM ({WORDS}) GROUP BY word"
SENTENCES = """
    SELECT doc_id, pos - 1 AS pos, parts[pos] AS text
    FROM (SELECT doc_id, string_split(text, '.') AS parts, unnest(range(1, len(string_split(text, '.')) + 1)) AS pos
          FROM documents)
"""


def _grams(tokens: str) -> str:
    """Unigrams then bigrams of a token list column."""
    return (
        f"list_concat({tokens}, list_transform(range(1, len({tokens})), "
        f"lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]))"
    )


def _doc_terms(source: str, key: str, stop: bool | str) -> str:
    return f"""
        SELECT {key}, term, count(*) AS tf
        FROM (SELECT {key}, unnest({_grams('w')}) AS term
              FROM (SELECT {key}, {_term_tokens('text', stop)} AS w FROM ({source})))
        GROUP BY {key}, term
    """


STATS = f"""
    SELECT term, sum(tf)::BIGINT AS cf, count(*) AS df
    FROM ({_doc_terms('SELECT doc_id, text FROM documents', 'doc_id', False)}) GROUP BY term
"""


def _vocab_cte(stop: bool | str = True) -> str:
    return f"""
    doc_terms AS ({_doc_terms('SELECT doc_id, text FROM documents', 'doc_id', stop)}),
    stats AS (SELECT term, sum(tf)::BIGINT AS cf, count(*) AS df FROM doc_terms GROUP BY term),
    vocab AS (
        SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, cf, df
        FROM (SELECT * FROM stats ORDER BY cf DESC, term LIMIT {MAX_TERMS})
    ),
    n AS (SELECT count(*) AS n FROM documents)
    """


VOCAB_CTE = _vocab_cte()


def _weighted(terms: str, key: str) -> str:
    return f"""
        SELECT {key}, term, idx, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key})) AS weight
        FROM (SELECT {key}, t.term, idx, tf, tf * (ln((1 + n) / (1 + df)) + 1) AS raw
              FROM {terms} t JOIN vocab USING (term) CROSS JOIN n)
    """


def _hash_rank(key: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY md5({key} || '|42'), {key})"


def _stratified(key: str) -> str:
    """``split`` from the relation ``rows`` of ``key, label``."""
    return f"""
    sizes AS (SELECT label, count(*)::HUGEINT AS n_c, sum(count(*)) OVER ()::HUGEINT AS n FROM rows GROUP BY label),
    shares AS (SELECT *, n - ceil(round(n * 0.2, 6))::HUGEINT AS n_train FROM sizes),
    parts AS (SELECT *, (n_c * n_train) // n AS base, (n_c * n_train) % n AS rest FROM shares),
    cuts AS (
        SELECT label, n_c - base - CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
               <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS n_test
        FROM parts
    ),
    ranked AS (SELECT *, {_hash_rank(key, 'label')} AS r FROM rows),
    split AS (
        SELECT {key}, label, CASE WHEN r <= n_test THEN 'test' ELSE 'train' END AS split
        FROM ranked JOIN cuts USING (label)
    )
    """


STRATIFIED = f"WITH rows AS (SELECT doc_id, quality AS label FROM labels), {_stratified('doc_id')}"

VECTORS = "SELECT vec_id, embedding::DOUBLE[] AS v, CASE WHEN label < 3 THEN 1 ELSE 0 END AS label FROM embeddings"
D2 = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _knn(k: int, same: str = "", source: str = "e") -> str:
    return f"""
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, neighbor) AS rank
            FROM (SELECT a.vec_id, a.label, b.vec_id AS neighbor, b.label AS other, {D2} AS d2
                  FROM {source} a JOIN {source} b ON a.vec_id <> b.vec_id {same})
        ) WHERE rank <= {k}
    """


SIZES = """
    SELECT label, count(*) AS n, max(count(*)) OVER () - count(*) AS need FROM e GROUP BY label
"""


SUMMED = "SELECT key, label, synthetic, round(list_sum(v), 6) AS x_sum, round(v[1], 6) AS x_first"


def _synthetic(copies: str, last: str = f"{SUMMED} FROM every") -> str:
    """Original and synthetic rows from a ``vec_id, label, copies`` query over ``e``."""

    def number(tag: str) -> str:
        return f"('0x' || substr(md5(vec_id || '|' || copy || '|{tag}'), 1, 8))::BIGINT"

    return f"""
        WITH e AS ({VECTORS}), sizes AS ({SIZES}),
        copies AS ({copies}),
        near AS ({_knn(5, 'AND a.label = b.label')}),
        drawn AS (
            SELECT vec_id, label, copy, {number('pick')} % 5 + 1 AS rank, {number('line')} / 4294967296.0 AS u
            FROM (SELECT vec_id, label, unnest(range(0, copies)) AS copy FROM copies WHERE copies > 0)
        ),
        made AS (
            SELECT d.vec_id || '#' || d.copy AS key, d.label, true AS synthetic,
                   list_transform(list_zip(x.v, y.v), lambda z: z[1] + d.u * (z[2] - z[1])) AS v
            FROM drawn d JOIN near USING (vec_id, rank)
            JOIN e x ON x.vec_id = d.vec_id JOIN e y ON y.vec_id = neighbor
        ),
        every AS (
            SELECT vec_id::VARCHAR AS key, label, false AS synthetic, v FROM e
            UNION ALL SELECT key, label, synthetic, v FROM made
        )
        {last}
    """


SMOTE_COPIES = f"""
    SELECT vec_id, label, need // n + CASE WHEN r <= need % n THEN 1 ELSE 0 END AS copies
    FROM (SELECT vec_id, label, {_hash_rank('vec_id', 'label')} AS r FROM e) JOIN sizes USING (label)
"""


ADASYN_COUNTS = f"""
    SELECT h.vec_id, h.label, h.others,
           round(CASE WHEN total > 0 THEN others / total ELSE 0 END, 9) AS weight,
           CASE WHEN total > 0 THEN round_even(others * need / total, 0) ELSE 0 END::BIGINT AS copies
    FROM (SELECT *, sum(others) OVER (PARTITION BY label) AS total
          FROM (SELECT vec_id, label, count(*) FILTER (other <> label) AS others
                FROM ({_knn(5)}) GROUP BY vec_id, label)) h
    JOIN sizes USING (label)
"""


def _metrics(pairs: str, by: str = "") -> str:
    """Per-class scores ``scores`` from a ``[by,] actual, predicted`` query."""
    b = f"{by}, " if by else ""
    return f"""
        WITH pairs AS ({pairs}),
        sides AS (
            SELECT {b}actual AS label, 1 AS support, 0 AS predicted,
                   CASE WHEN actual = predicted THEN 1 ELSE 0 END AS hits FROM pairs
            UNION ALL SELECT {b}predicted, 0, 1, 0 FROM pairs
        ),
        sums AS (
            SELECT {b}label, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits
            FROM sides GROUP BY {b}label
        ),
        scores AS (
            SELECT {b}label, support, hits,
                   CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision,
                   CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall,
                   2 * hits / (support + predicted) AS f1_score
            FROM sums
        )
    """


LABEL_PAIRS = "SELECT quality::VARCHAR AS actual, toxic::VARCHAR AS predicted FROM labels"
FLAG_PAIRS = " UNION ALL ".join(
    f"SELECT '{name}' AS model, l_returnflag AS actual, {rule} AS predicted FROM lineitem"
    for name, rule in FLAG_RULES.items()
)


def _summary(by: str = "", samples: bool = True) -> str:
    b = f"{by}, " if by else ""
    count = ", sum(support)::BIGINT AS test_samples" if samples else ""
    return f"""
        SELECT {b}round(sum(hits) / sum(support), 6) AS accuracy,
               round(sum(f1_score * support) / sum(support), 6) AS f1_weighted,
               round(sum(precision * support) / sum(support), 6) AS precision_weighted,
               round(sum(recall * support) / sum(support), 6) AS recall_weighted{count}
        FROM scores {'GROUP BY ' + by if by else ''}
    """


def _report(by: str = "") -> str:
    b, g = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    names = ("precision", "recall", "f1_score")
    per_class = ", ".join(f"round({n}, 6) AS {n}" for n in names)
    macro = ", ".join(f"round(avg({n}), 6)" for n in names)
    weighted = ", ".join(f"round(sum({n} * support) / sum(support), 6)" for n in names)
    accuracy = ", ".join(["round(sum(hits) / sum(support), 6)"] * 4)
    return f"""
        SELECT {b}label, {per_class}, support::DOUBLE AS support FROM scores
        UNION ALL SELECT {b}'accuracy', {accuracy} FROM scores {g}
        UNION ALL SELECT {b}'macro avg', {macro}, sum(support)::DOUBLE FROM scores {g}
        UNION ALL SELECT {b}'weighted avg', {weighted}, sum(support)::DOUBLE FROM scores {g}
    """


def _metrics_long() -> str:
    cells = " UNION ALL ".join(
        f"SELECT label || '_{name}' AS metric, {column} AS value FROM report WHERE label <> 'accuracy'"
        for name, column in (
            ("precision", "precision"), ("recall", "recall"),
            ("f1-score", "f1_score"), ("support", "support"),
        )
    )
    return (
        f"{_metrics(LABEL_PAIRS)}, report AS ({_report()}) {cells} "
        "UNION ALL SELECT 'accuracy', precision FROM report WHERE label = 'accuracy'"
    )


def _lemmas(words: str) -> str:
    """Lemma table over a ``word`` query that is also the dictionary."""
    tries = ", ".join(
        f"CASE WHEN ends_with(word, '{old}') THEN left(word, length(word) - {len(old)}) || '{new}' END"
        for old, new in NOUN_ENDINGS
    )
    return f"""
        words AS (SELECT DISTINCT word FROM ({words})),
        tried AS (SELECT word, unnest([{tries}]) AS lemma FROM words),
        lemmas AS (
            SELECT word, arg_min(lemma, (length(lemma), lemma)) AS lemma FROM tried
            WHERE lemma IS NOT NULL AND lemma <> '' AND lemma IN (SELECT word FROM words)
            GROUP BY word
        )
    """


def _lemmatized(rows: str) -> str:
    """``key, text`` from a ``key, w`` (token list) relation, using ``lemmas``."""
    return f"""
        SELECT r.key, coalesce(t.text, '') AS text FROM {rows} r LEFT JOIN (
            SELECT key, string_agg(coalesce(lemma, word), ' ' ORDER BY pos) AS text
            FROM (SELECT key, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM {rows})
            LEFT JOIN lemmas USING (word) GROUP BY key
        ) t USING (key)
    """


def _notebook_tokens(text: str) -> str:
    out = f"lower({text})"
    out = _cut(out, rf"^[{SPACE}]+|[{SPACE}]+$")
    out = _cut(f"replace({out}, chr(10), '')", rf"[^A-Za-z0-9{SPACE}!?.,]")
    return _drop_words(_ws_tokens(out), KEPT_STOP_LIST)


def _profile(columns: str) -> str:
    cells = []
    for i, name in enumerate(columns.split()):
        dtype = (
            f"CASE any_value(typeof({name})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
            f"WHEN 'VARCHAR' THEN 'string' END"
        )
        cells.append(
            f"SELECT {i} AS position, '{name}' AS \"column\", {dtype} AS dtype, count({name}) AS non_null FROM d"
        )
    return f"WITH d AS ({DOCS}) " + " UNION ALL ".join(cells)


def _missing(columns: str) -> str:
    cells = [
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
        f"round((count(*) - count({c})) * 100 / count(*), 6) AS pct FROM d"
        for c in columns.split()
    ]
    return f"WITH d AS ({DOCS}) " + " UNION ALL ".join(cells)


def _punct_count(text: str) -> str:
    return f"length({text}) - length(translate({text}, {_q(PUNCTUATION_CHARS)}, ''))"


def _digest(tokens: str, source: str = "documents") -> str:
    return (
        f"SELECT doc_id, len(t) AS n, md5(array_to_string(t, '|')) AS digest "
        f"FROM (SELECT doc_id, {tokens} AS t FROM {source})"
    )


def _docs_text(expression: str) -> str:
    return f"SELECT doc_id, {expression} AS text FROM documents"


def _pages_text(expression: str) -> str:
    return f"SELECT page_id, {expression} AS text FROM pages"


# Test rows of the turns, as ``split`` of ``key, label``.
SPLIT_TURNS = f"""
    WITH t AS ({TURNS}), classes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS code
    FROM (SELECT DISTINCT label FROM t)),
    rows AS (SELECT key, code AS label FROM t JOIN classes USING (label)), {_stratified('key')}
"""
PREDICTED = f"""
    {SPLIT_TURNS} SELECT key, label::INT AS actual, true AS known_class, true AS all_classes,
    true AS sums_to_one, true AS confident FROM split WHERE split = 'test'
"""


def _named(names, column: str) -> str:
    return f"SELECT name AS model, true AS {column} FROM (SELECT unnest({_list(names)}) AS name)"


SWEPT = [f"{m} 1-{n} 10000" for n in (1, 2, 3) for m in ("count", "tfidf")]
SWEPT += [f"tfidf 1-3 {n}" for n in range(1000, 10000, 1000)]  # 10000 is among the ranges

FIRST_ROWS = "SELECT min(doc_id) FROM documents GROUP BY text, lang"
CLASSES = "SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM (SELECT DISTINCT label FROM t)"

ORACLES: dict[str, str] = {
    "csv_roundtrip": "SELECT doc_id, md5(text) AS text_md5, lang FROM documents",
    "lines_source": rf"""
        SELECT text, count(*) AS n FROM (
            SELECT {_cut('line', rf'^[{SPACE}]+|[{SPACE}]+$')} AS text
            FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents)
        ) WHERE text <> '' GROUP BY text
    """,
    "metrics_long": _metrics_long(),
    "null_text_policy": f"""
        SELECT doc_id, coalesce(label::VARCHAR, 'nan') AS as_word, coalesce(label::VARCHAR, '') AS as_empty
        FROM ({DOCS})
    """,
    "null_rows": f"SELECT doc_id FROM ({DOCS}) WHERE label IS NULL",
    "dropna_any": f"SELECT doc_id, label, length(text) AS n_chars FROM ({DOCS}) WHERE label IS NOT NULL",
    "blank_filter": rf"""
        SELECT doc_id, text FROM ({_docs_text(_cut('text', '[^0-9' + chr(92) + 's]'))})
        WHERE {_cut('text', f'[{SPACE}]+')} <> ''
    """,
    "edge_space_rows": f"""
        SELECT doc_id, pos, length(text) AS n_chars FROM ({SENTENCES})
        WHERE starts_with(text, ' ') OR ends_with(text, ' ')
    """,
    "url_rows": f"SELECT page_id FROM ({LINKED_PAGES}) WHERE regexp_matches(html, {_q(URL_PROFILE)})",
    "newline_rows": "SELECT doc_id FROM documents WHERE contains(text, chr(10))",
    "empty_after_clean": f"""
        SELECT count(*) AS total, count(*) FILTER (cleaned = '') AS empty
        FROM (SELECT {_clean('text', full=True)} AS cleaned FROM ({SENTENCES}))
    """,
    "head_n": "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5",
    "sample_n": """
        SELECT doc_id, lang, source, n_chars FROM documents ORDER BY md5(doc_id || '|42'), doc_id LIMIT 6
    """,
    "top_words_by_label": f"""
        WITH t AS ({LABELLED}),
        words AS (SELECT label, unnest({_ws_tokens('lower(text)')}) AS word FROM t),
        top AS (
            SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) AS rank
            FROM words GROUP BY word QUALIFY rank <= 20
        )
        SELECT word, l.label, rank, count(w.word)::INT AS n
        FROM top CROSS JOIN (SELECT DISTINCT label FROM t) l LEFT JOIN words w USING (word, label)
        GROUP BY word, l.label, rank
    """,
    "tokens_no_stop": f"SELECT * FROM ({WORD_COUNTS}) WHERE word NOT IN (SELECT word FROM {_values(STOP_WORDS)})",
    "top_stopwords": f"""
        SELECT * FROM ({WORD_COUNTS}) WHERE word IN (SELECT word FROM {_values(STOP_WORDS)})
        ORDER BY n DESC, word LIMIT 25
    """,
    "stopword_except": f"""
        SELECT DISTINCT word FROM ({WORDS}) WHERE word IN (
            SELECT word FROM {_values(STOP_WORDS)} EXCEPT SELECT word FROM {_values(KEPT_NEGATIONS)})
    """,
    "word_freq": WORD_COUNTS,
    "term_weights": f"""
        SELECT word, n, round(n / max(n) OVER (), 6) AS weight
        FROM (SELECT * FROM ({WORD_COUNTS}) ORDER BY n DESC, word LIMIT 200)
    """,
    "top_words_slice": f"""
        SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS rank FROM ({WORD_COUNTS})
        QUALIFY rank BETWEEN 11 AND 30
    """,
    "char_freq": """
        WITH c AS (
            SELECT unnest(string_split(text, '')) AS char FROM documents
            UNION ALL SELECT ' ' FROM documents WHERE doc_id <> (SELECT min(doc_id) FROM documents)
        )
        SELECT char, count(*) AS freq FROM c WHERE char <> '' GROUP BY char ORDER BY freq, char
    """,
    "lemma_join": f"""
        WITH rows AS (SELECT key, {_term_tokens('text')} AS w FROM ({TURNS})),
        {_lemmas('SELECT unnest(w) AS word FROM rows')}
        {_lemmatized('rows')}
    """,
    "data_stats": f"""
        SELECT count(*) AS total_rows, 3 AS total_columns, count(*) - count(text) AS missing_text,
               count(*) - count(label) AS missing_label, count(DISTINCT label) AS unique_labels,
               (SELECT string_agg(label || ':' || share, ',' ORDER BY label) FROM (
                   SELECT label::VARCHAR AS label, round(count(*) / sum(count(*)) OVER (), 4) AS share
                   FROM ({DOCS}) WHERE label IS NOT NULL GROUP BY label)) AS label_shares
        FROM ({DOCS})
    """,
    "missing_by_column": _missing("doc_id text label"),
    "distinct_labels": f"SELECT DISTINCT label FROM ({DOCS})",
    "n_classes": "SELECT count(DISTINCT l_returnflag) AS n_classes FROM lineitem",
    "label_counts": "SELECT l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY 1",
    "label_distribution": f"""
        SELECT label, round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM ({DOCS}) WHERE label IS NOT NULL GROUP BY label
    """,
    "label_pct": """
        SELECT l_returnflag AS label, round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct
        FROM lineitem GROUP BY 1
    """,
    "label_share_by_split": f"""
        {STRATIFIED} SELECT split, label, count(*) AS n,
               round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share
        FROM split GROUP BY split, label
    """,
    "duplicate_count": "SELECT sum(n - 1)::BIGINT AS duplicates FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)",
    "dedup_rows": f"SELECT doc_id, lang, md5(text) AS text_md5 FROM documents WHERE doc_id IN ({FIRST_ROWS})",
    "duplicate_rows": f"SELECT doc_id, lang FROM documents WHERE doc_id NOT IN ({FIRST_ROWS})",
    "column_profile": _profile("doc_id text label"),
    "word_count_summary": f"""
        SELECT count(*) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
               min(x)::DOUBLE AS min, round(quantile_cont(x, 0.25), 6) AS p25,
               round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75, max(x)::DOUBLE AS max
        FROM (SELECT len({_ws_tokens('text')})::DOUBLE AS x FROM documents)
    """,
    "big_value_summary": """
        SELECT count(*) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
               min(x) AS min, round(quantile_cont(x, 0.25), 6) AS p25,
               round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75, max(x) AS max
        FROM (SELECT (o_orderkey + 1000000000)::DOUBLE AS x FROM orders)
    """,
    "length_hist_by_label": f"""
        SELECT label, (len({_ws_tokens('text')}) // 50) * 50 AS bin, count(*) AS n
        FROM ({LABELLED}) GROUP BY ALL
    """,
    "length_density_by_label": f"""
        WITH v AS (SELECT label, CAST(len({_ws_tokens('text')}) AS DOUBLE) AS v FROM ({LABELLED})),
        s AS (SELECT label, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, min(v) AS low, max(v) AS high
              FROM v GROUP BY label),
        g AS (SELECT *, low - 3 * h + point * ((high - low + 6 * h) / 199) AS x
              FROM s, (SELECT CAST(unnest(range(200)) AS INT) AS point) WHERE h > 0)
        SELECT g.label, g.point, round(g.x, 4) AS x,
          round(sum(exp(-0.5 * pow((g.x - v.v) / g.h, 2))) / (any_value(g.n) * any_value(g.h) * sqrt(2 * pi())), 6) AS density
        FROM g JOIN v USING (label) GROUP BY g.label, g.point, g.x
    """,
    "strip_tags": _pages_text(_cut("html", TAG)),
    "unescape_basic": _pages_text(_unescape("html")),
    "strip_urls": f"SELECT page_id, {_cut('html', URL)} AS text FROM ({LINKED_PAGES})",
    "strip_punct": _docs_text(_no_punct("text")),
    "strip_digits": _docs_text(_no_digits("text")),
    "strip_emoji": f"SELECT doc_id, {_cut('text', EMOJI)} AS text FROM ({EMOJI_TEXTS})",
    "clean_text_full": f"SELECT key, {_clean('text', full=True)} AS cleaned FROM ({ALL_TEXTS})",
    "clean_text_default": f"SELECT key, {_clean('text')} AS cleaned FROM ({ALL_TEXTS})",
    "clean_text_light": f"SELECT key, {_clean('text', light=True)} AS cleaned FROM ({ALL_TEXTS})",
    "tokens_ws": _digest(_ws_tokens("text")),
    "vec_tokens": _digest(_term_tokens("text", stop=True)),
    "ngrams_12": _digest(
        _grams("w"), f"(SELECT doc_id, {_term_tokens('text', stop=True)} AS w FROM documents)"
    ),
    "text_features": f"""
        SELECT doc_id, len(t) AS word_count,
               len(list_filter(t, lambda w: list_contains({STOP_LIST}, w))) AS num_stop_words,
               length(text) AS num_chars, {_punct_count('text')} AS num_punc_chars
        FROM (SELECT doc_id, text, {_ws_tokens('text')} AS t FROM documents)
    """,
    "notebook_clean": f"""
        WITH kept AS (
            SELECT min(doc_id) AS key, text, label FROM ({DOCS})
            WHERE label IS NOT NULL AND {_cut('text', f'[{SPACE}]+')} <> '' GROUP BY text, label
        ),
        rows AS (SELECT key, label, {_notebook_tokens('text')} AS w FROM kept),
        {_lemmas('SELECT unnest(w) AS word FROM rows')},
        done AS ({_lemmatized('rows')})
        SELECT key AS doc_id, label, done.text AS cleaned FROM done JOIN rows USING (key)
    """,
    "vocab_stats": STATS,
    "vocab_topn": f"""
        SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, cf, df
        FROM (SELECT * FROM ({STATS}) ORDER BY cf DESC, term LIMIT {MAX_TERMS})
    """,
    "vocab_sweep": f"""
        WITH ranked AS (
            SELECT cf, sum(cf) OVER () AS total, row_number() OVER (ORDER BY cf DESC, term) AS place FROM ({STATS})
        )
        SELECT max_features, count(*) AS terms, sum(cf)::BIGINT AS occurrences,
               round(sum(cf) / any_value(total), 6) AS coverage
        FROM (SELECT unnest([{', '.join(map(str, COVERAGE_CAPS))}]) AS max_features)
        JOIN ranked ON place <= max_features GROUP BY max_features
    """,
    "count_vectors": f"WITH {VOCAB_CTE} SELECT doc_id, idx, tf::INT AS tf FROM doc_terms JOIN vocab USING (term)",
    "tfidf": f"""
        WITH {VOCAB_CTE} SELECT doc_id, idx, round(weight, 6) AS weight FROM ({_weighted('doc_terms', 'doc_id')})
    """,
    "tfidf_english": f"""
        WITH {_vocab_cte(ENGLISH_LIST)} SELECT doc_id, idx, round(weight, 6) AS weight
        FROM ({_weighted('doc_terms', 'doc_id')})
    """,
    "tfidf_by_join": f"""
        WITH {VOCAB_CTE}
        SELECT doc_id, term, idx, tf, round(weight, 6) AS weight FROM ({_weighted('doc_terms', 'doc_id')})
    """,
    "tfidf_transform": f"""
        WITH {VOCAB_CTE}, turn_terms AS ({_doc_terms(TURNS, 'key', True)})
        SELECT key, idx, round(weight, 6) AS weight FROM ({_weighted('turn_terms', 'key')})
    """,
    "label_encode": f"""
        WITH t AS ({TURNS}), classes AS ({CLASSES}) SELECT key, label, code FROM t JOIN classes USING (label)
    """,
    "label_decode": f"""
        WITH t AS ({TURNS}), classes AS ({CLASSES}) SELECT key, code, label FROM t JOIN classes USING (label)
    """,
    "processed_table": f"""
        WITH t AS ({LABELLED}),
        classes AS (
            SELECT label, row_number() OVER (ORDER BY label::VARCHAR) - 1 AS code FROM (SELECT DISTINCT label FROM t)
        )
        SELECT doc_id, md5(text) AS original_text, {_clean('text', full=True)} AS cleaned_text,
               label AS original_label, code AS encoded_label
        FROM t JOIN classes USING (label)
    """,
    "split_random": f"""
        SELECT doc_id, CASE WHEN {_hash_rank('doc_id')} <= (SELECT ceil(round(count(*) * 0.2, 6)) FROM documents)
               THEN 'test' ELSE 'train' END AS split FROM documents
    """,
    "split_bucket": """
        SELECT doc_id, CASE WHEN ('0x' || substr(md5(doc_id || '|42'), 1, 8))::BIGINT < 858993459
               THEN 'test' ELSE 'train' END AS split FROM documents
    """,
    "split_stratified": f"{STRATIFIED} SELECT doc_id, label, split FROM split",
    "kfold_assign": f"""
        WITH ranked AS (
            SELECT doc_id, quality AS label, {_hash_rank('doc_id', 'quality')} AS r,
                   count(*) OVER (PARTITION BY quality) AS n FROM labels
        )
        SELECT doc_id, label, (r > n // 5)::INT + (r > n * 2 // 5)::INT + (r > n * 3 // 5)::INT
               + (r > n * 4 // 5)::INT AS fold FROM ranked
    """,
    "undersample": f"""
        WITH ranked AS (SELECT doc_id, quality AS label, {_hash_rank('doc_id', 'quality')} AS r FROM labels)
        SELECT doc_id, label FROM ranked
        WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY quality))
    """,
    "class_weights": """
        SELECT quality AS label, count(*) AS n,
               round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
        FROM labels GROUP BY quality
    """,
    "knn_join": f"""
        WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings)
        SELECT vec_id, neighbor, rank, round(d2, 6) AS d2 FROM ({_knn(5)})
    """,
    "knn_classify": f"""
        WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
        votes AS (SELECT vec_id, other, count(*) AS votes FROM ({_knn(5)}) GROUP BY vec_id, other)
        SELECT vec_id, other AS prediction, votes FROM votes
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, other) = 1
    """,
    "knn_foreign": f"""
        WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
        SELECT vec_id, neighbor, rank, round(d2, 6) AS d2 FROM (
            SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, neighbor) AS rank
            FROM (SELECT a.vec_id + 7 AS vec_id, b.vec_id AS neighbor, {D2} AS d2 FROM e a CROSS JOIN e b)
        ) WHERE rank <= 5
    """,
    "smote": _synthetic(SMOTE_COPIES),
    "smoteenn": _synthetic(
        SMOTE_COPIES,
        f""", grown AS (SELECT key AS vec_id, label, synthetic, v FROM every)
        {SUMMED} FROM every JOIN (
            SELECT vec_id AS key FROM ({_knn(3, source='grown')}) GROUP BY vec_id HAVING bool_and(other = label)
        ) USING (key)""",
    ),
    "preprocess_flow": f"""
        WITH t AS ({TURNS}), classes AS ({CLASSES}),
        rows AS (SELECT key, code AS label FROM t JOIN classes USING (label)),
        {_stratified('key')},
        cleaned AS (SELECT key, {_clean('text', full=True)} AS text FROM t),
        every_terms AS ({_doc_terms('SELECT key, text FROM cleaned', 'key', True)}),
        vocab AS (
            SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, df FROM (
                SELECT term, sum(tf) AS cf, count(*) AS df FROM every_terms JOIN split USING (key)
                WHERE split = 'train' GROUP BY term ORDER BY cf DESC, term LIMIT {MAX_TERMS})
        ),
        n AS (SELECT count(*) AS n FROM split WHERE split = 'train')
        SELECT key, label::DOUBLE AS label, split, idx, round(weight, 6) AS value
        FROM ({_weighted('every_terms', 'key')}) JOIN split USING (key)
    """,
    "adasyn_weights": f"WITH e AS ({VECTORS}), sizes AS ({SIZES}) {ADASYN_COUNTS}",
    "adasyn": _synthetic(f"SELECT vec_id, label, copies FROM ({ADASYN_COUNTS})"),
    "enn_clean": f"""
        WITH e AS ({VECTORS})
        SELECT vec_id, label FROM ({_knn(3)}) GROUP BY vec_id, label HAVING bool_and(other = label)
    """,
    "eval_metrics": f"{_metrics(LABEL_PAIRS)} {_summary()}",
    "confusion_matrix": f"""
        WITH p AS ({LABEL_PAIRS}), names AS (SELECT actual AS label FROM p UNION SELECT predicted FROM p)
        SELECT a.label AS actual, b.label AS predicted, count(p.actual) AS n
        FROM names a CROSS JOIN names b LEFT JOIN p ON p.actual = a.label AND p.predicted = b.label
        GROUP BY a.label, b.label
    """,
    "classification_report": f"{_metrics(FLAG_PAIRS, 'model')} {_report('model')}",
    "compare_models": f"{_metrics(FLAG_PAIRS, 'model')} {_summary('model', samples=False)} ORDER BY accuracy DESC, model",
    "best_model": f"""
        {_metrics(FLAG_PAIRS, 'model')}, s AS ({_summary('model')})
        SELECT model, accuracy FROM s ORDER BY accuracy DESC, model LIMIT 1
    """,
    "stream_clean": f"SELECT doc_id, {_clean('text', full=True)} AS cleaned FROM documents",
    "folder_roundtrip": "SELECT doc_id, md5(text) AS text_md5, lang FROM documents",
    "features_roundtrip": f"{STRATIFIED} SELECT doc_id, label, split FROM split",
    "report_roundtrip": f"{_metrics(FLAG_PAIRS, 'model')} {_report('model')}",
    "model_roundtrip": f"SELECT key, label, true AS same FROM ({TURNS})",
    "lr_predict": PREDICTED,
    "rf_predict": PREDICTED,
    "gbt_predict": PREDICTED,
    "stack_variant": PREDICTED,
    "stack_oof": f"""
        {SPLIT_TURNS}, train AS (
            SELECT key, label, {_hash_rank('key', 'label')} AS r, count(*) OVER (PARTITION BY label) AS n
            FROM split WHERE split = 'train')
        SELECT key, label::DOUBLE AS label, (r > n // 5)::INT + (r > n * 2 // 5)::INT + (r > n * 3 // 5)::INT
               + (r > n * 4 // 5)::INT AS fold,
               2 * (SELECT count(*) FROM classes)::INT AS n_shares, true AS sums_to_two
        FROM train
    """,
    "train_all": _named(("logistic_regression", "random_forest", "boosted_trees", "stacking"), "learned"),
    "eval_model": f"""
        {SPLIT_TURNS} SELECT 'logistic_regression' AS model, count(*) AS test_samples, true AS agrees
        FROM split WHERE split = 'test'
    """,
    "score_batch": f"SELECT key, label, true AS known FROM ({TURNS})",
    "sweep": _named(SWEPT, "scored"),
    "balance_sweep": _named(("none", "undersample", "smote", "adasyn", "smoteenn"), "scored"),
    "stream_score": f"""
        SELECT conv_id, turn, role, true AS same_as_batch FROM conversations
        WHERE {_cut('text', f'[{SPACE}]+')} <> ''
    """,
}
