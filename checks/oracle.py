"""SQL for DuckDB, one statement per query, over the same tables."""

from __future__ import annotations

from checks import views as V

# Fixed values, written out here too, so that a wrong one in the library shows.
CATEGORY_NAMES = {
    0: "수면", 1: "정신건강", 2: "운동", 3: "식단",
    4: "만성질환", 5: "여성건강", 6: "유전자", 7: "미용",
}
FUNCTION_NAMES = {"A": "정보제공", "B": "데이터기록관리", "C": "매칭연결", "D": "개입치료"}
MINORITY_KEYWORDS = {
    "유전자": ["유전자", "dna", "유전", "genetic"],
    "미용": ["피부", "시술", "미용", "성형", "뷰티", "skin", "beauty"],
}
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]
STORE_URL_TEMPLATE = "https://play.google.com/store/apps/details?id=%s&hl=%s&gl=%s"
TEXT_SEPARATOR = " [SEP] 수집 데이터: "

ORACLE: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _view(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {source}"


def _case(column: str, table: dict) -> str:
    arms = " ".join(
        f"WHEN {_text(k) if isinstance(k, str) else k} THEN {_text(v) if isinstance(v, str) else v}"
        for k, v in table.items()
    )
    return f"CASE {column} {arms} END"


def _with(*parts: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts) + "\n"


APPS = ("apps", _view(V.APPS, "documents"))
DETAILS = ("details", _view(V.DETAILS, "pages"))
LABELLED = ("labelled", "SELECT * FROM documents JOIN labels USING (doc_id)")
JUDGED = ("judged", _view(V.JUDGED, "labelled"))
VECTORS = (
    "vectors",
    "SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, "
    + ", ".join(f"{e} AS {n}" for n, e in V.VECTOR_LABELS.items()) + " FROM embeddings",
)


def _logits(classes: int, weight: str) -> str:
    return (
        f"list_transform(range({classes}), lambda c: list_dot_product(v, "
        f"list_transform(range({V.WIDTH}), lambda j: CAST({weight} AS DOUBLE))) "
        "+ CAST(c AS DOUBLE) * CAST(0.01 AS DOUBLE))"
    )


LOGITS = (
    "logits",
    f"SELECT *, {_logits(8, '((c * 31 + j * 17) % 13 - 6) / 10')} AS lc, "
    f"{_logits(4, '((c * 29 + j * 11) % 7 - 3) / 10')} AS lf FROM vectors",
)
PROBS = (
    "probs",
    "SELECT *, list_transform(ec, lambda x: x / list_sum(ec)) AS pc, "
    "list_transform(ef, lambda x: x / list_sum(ef)) AS pf FROM ("
    "SELECT *, list_transform(lc, lambda x: exp(x - list_max(lc))) AS ec, "
    "list_transform(lf, lambda x: exp(x - list_max(lf))) AS ef FROM logits)",
)
SCORED = (
    "scored",
    "SELECT *, "
    f"{_case('category_pred', CATEGORY_NAMES)} AS predicted_category_name, "
    "category_pred AS predicted_category_id, "
    "substr('ABCD', function_pred + 1, 1) AS predicted_function_type, "
    f"{_case('substr(' + _text('ABCD') + ', function_pred + 1, 1)', FUNCTION_NAMES)} AS predicted_function_name, "
    "least(category_confidence, function_confidence) AS min_confidence FROM ("
    "SELECT *, CAST(list_position(pc, list_max(pc)) - 1 AS INTEGER) AS category_pred, "
    "CAST(list_position(pf, list_max(pf)) - 1 AS INTEGER) AS function_pred, "
    "round(list_max(pc), 6) AS category_confidence, round(list_max(pf), 6) AS function_confidence "
    "FROM probs)",
)
SCORING = (VECTORS, LOGITS, PROBS, SCORED)
AUDIT = (
    "predicted_category_id, predicted_category_name, predicted_function_type, "
    "predicted_function_name, category_confidence, function_confidence, min_confidence"
)


def _flags(text: str, groups: dict[str, list[str]] = V.GROUPS) -> str:
    arms = [
        "CASE WHEN " + " OR ".join(f"contains(lower({text}), {_text(k)})" for k in keywords)
        + f" THEN {_text(name)} END"
        for name, keywords in groups.items()
    ]
    return "concat_ws(',', " + ", ".join(arms) + ")"


APP_TEXT = "(coalesce(description, '') || ' ' || coalesce(app_name, ''))"
PRELABELLED = (
    "prelabelled",
    f"SELECT app_id, app_name, {AUDIT}, {_flags(APP_TEXT)} AS minority_candidate FROM apps "
    "LEFT JOIN scored ON app_id = CAST(vec_id AS VARCHAR)",
)

ORACLE["review_queue_topk"] = _with(*SCORING) + (
    "SELECT vec_id, category_pred AS category, function_pred AS function, category_confidence, "
    "function_confidence, min_confidence FROM scored ORDER BY min_confidence, vec_id LIMIT 100"
)
ORACLE["review_queue"] = _with(*SCORING) + (
    "SELECT vec_id, min_confidence, predicted_category_id FROM scored ORDER BY min_confidence, vec_id"
)
ORACLE["review_queue_minority_first"] = _with(APPS, *SCORING, PRELABELLED) + (
    "SELECT * FROM prelabelled ORDER BY minority_candidate <> '' DESC, "
    "min_confidence ASC NULLS LAST, app_id LIMIT 100"
)
ORACLE["review_positions"] = _with(APPS, *SCORING, (
    "flagged",
    f"SELECT app_id, min_confidence, length(description) AS chars, {_flags(APP_TEXT)} AS flags FROM apps "
    "LEFT JOIN scored ON app_id = CAST(vec_id AS VARCHAR)",
)) + (
    "SELECT row_number() OVER (ORDER BY flags <> '' DESC, min_confidence ASC NULLS LAST, app_id) AS position, "
    "app_id, min_confidence, CAST(chars AS INTEGER) AS chars FROM flagged"
)
ORACLE["prelabel_records"] = _with(APPS, *SCORING, PRELABELLED) + "SELECT * FROM prelabelled"
TEXT_SCORING = (
    APPS,
    ("texts", f"SELECT *, strlen(coalesce(description, '') || {_text(TEXT_SEPARATOR)} || coalesce(collected_data, '')) "
              "AS size FROM apps"),
    ("logits", "SELECT *, list_transform(range(8), lambda c: CAST(size * (c + 3) % 17 AS DOUBLE) / 10) AS lc, "
               "list_transform(range(4), lambda c: CAST(size * (c + 5) % 11 AS DOUBLE) / 10) AS lf FROM texts"),
    PROBS, SCORED,
)
ORACLE["prelabel_plan"] = _with(*TEXT_SCORING) + (
    f"SELECT app_id, category_id, {AUDIT}, {_flags(APP_TEXT, MINORITY_KEYWORDS)} AS minority_candidate FROM scored"
)
ORACLE["score_two_axis"] = _with(*SCORING) + f"SELECT vec_id, {AUDIT} FROM scored"
ORACLE["score_native_heads"] = ORACLE["score_two_axis"]
ORACLE["score_first_n"] = ORACLE["score_two_axis"] + " ORDER BY vec_id LIMIT 50"
ORACLE["confidence_summary"] = _with(APPS, *SCORING, PRELABELLED) + (
    "SELECT count(*) AS n, round(avg(category_confidence), 6) AS mean_category_confidence, "
    "round(avg(function_confidence), 6) AS mean_function_confidence, "
    "count(*) FILTER (WHERE minority_candidate <> '') AS minority_candidates FROM prelabelled"
)
ORACLE["minority_flag_counts"] = _with(
    APPS,
    ("flagged", f"SELECT unnest(string_split({_flags(APP_TEXT)}, ',')) AS flag FROM apps"),
) + "SELECT flag, count(*) AS n FROM flagged WHERE flag <> '' GROUP BY flag"

# Merge and label checks

OLD = "CAST(app_id AS BIGINT) % 3 = 0"
HAS_FUNCTION = r"coalesce(regexp_matches(function_type, '\S'), false)"
DROP = f"(coalesce(category_id = 'EXC', false) AND NOT {HAS_FUNCTION})"
DROP_STRICT = "coalesce(category_id = 'EXC', false)"


def _merged(drop: str) -> str:
    return (
        f"SELECT *, concat('r', country) AS labeled_by FROM apps WHERE {OLD} UNION ALL "
        f"SELECT *, NULL AS labeled_by FROM apps WHERE NOT ({OLD}) AND NOT {drop}"
    )


def _merge_counts(drop: str) -> str:
    return (
        f"SELECT count(*) FILTER (WHERE {OLD}) AS existing_rows, "
        f"count(*) FILTER (WHERE NOT ({OLD}) AND NOT {drop}) AS new_rows, "
        f"count(*) FILTER (WHERE NOT ({OLD}) AND {drop}) AS dropped_rows, "
        f"count(*) FILTER (WHERE {OLD} OR NOT {drop}) AS merged_rows FROM apps"
    )


ORACLE["merge_labeled"] = _with(APPS) + _merged(DROP)
ORACLE["merge_strict"] = _with(APPS) + _merged(DROP_STRICT)
ORACLE["merge_counts"] = _with(APPS) + _merge_counts(DROP)
ORACLE["merge_counts_strict"] = _with(APPS) + _merge_counts(DROP_STRICT)
ORACLE["class_distribution"] = _with(APPS, ("merged", _merged(DROP))) + (
    "SELECT 'category_id' AS axis, category_id AS value, count(*) AS n FROM merged "
    "WHERE category_id IS NOT NULL GROUP BY category_id UNION ALL "
    "SELECT 'function_type', function_type, count(*) FROM merged "
    "WHERE function_type IS NOT NULL GROUP BY function_type"
)
REAL = "category_id IS NOT NULL AND category_id <> 'EXC'"
NUMBER = "TRY_CAST(category_id AS INTEGER)"
ORACLE["label_contract"] = _with(APPS) + " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {bad}) AS violations FROM apps"
    for rule, bad in {
        "category_missing": "category_id IS NULL",
        "category_not_integer": f"{REAL} AND {NUMBER} IS NULL",
        "category_outside_guide": f"{REAL} AND {NUMBER} NOT BETWEEN 0 AND 7",
        "function_missing": f"NOT {HAS_FUNCTION}",
        "function_unknown": f"{HAS_FUNCTION} AND function_type NOT IN ('A', 'B', 'C', 'D')",
        "boundary_without_note": "is_boundary_case AND note IS NULL",
    }.items()
)
ORACLE["function_violations"] = _with(APPS) + (
    "SELECT function_type, count(*) AS n FROM apps "
    "WHERE coalesce(function_type NOT IN ('A', 'B', 'C', 'D'), true) GROUP BY function_type"
)
ORACLE["boundary_report"] = _with(APPS) + (
    "SELECT category_id, count(*) AS boundary_rows, "
    "count(*) FILTER (WHERE note IS NULL) AS without_note FROM apps WHERE is_boundary_case "
    "GROUP BY category_id"
)

# Records and text

_NA = ", ".join(_text(t) for t in NA_TOKENS)
ORACLE["records_csv_round_trip"] = _with(APPS) + "SELECT " + ", ".join(
    c if c == "is_boundary_case" else f"CASE WHEN {c} NOT IN ({_NA}) THEN {c} END AS {c}"
    for c in V.APPS
) + " FROM apps"
ORACLE["rejected_cells"] = _with(("cells", _view({"half": "'half' || CAST(doc_id % 2 AS VARCHAR)", **V.BAD_CELLS}, "documents"))) + (
    "SELECT half AS folder, 'category_id' AS \"column\", category_id AS value, count(*) AS n FROM cells "
    "WHERE category_id IN ('six', '2.5') GROUP BY ALL UNION ALL "
    "SELECT half, 'function_type', function_type, count(*) FROM cells WHERE function_type = 'E' GROUP BY ALL UNION ALL "
    "SELECT half, 'is_boundary_case', is_boundary_case, count(*) FROM cells WHERE is_boundary_case = 'maybe' "
    "GROUP BY ALL UNION ALL "
    "SELECT half, 'min_confidence', min_confidence, count(*) FROM cells WHERE min_confidence <> '0.5' GROUP BY ALL"
)
_URL = STORE_URL_TEMPLATE.split("%s")


def _records(source: str) -> str:
    built = (
        f"{_text(_URL[0])} || app_id || {_text(_URL[1])} || 'ko' || {_text(_URL[2])} || upper('kr')"
    )
    blank = ", ".join(
        f"CAST(NULL AS {'BOOLEAN' if c == 'is_boundary_case' else 'VARCHAR'}) AS {c}" for c in
        ("idea_desc", "collected_data", "category_id", "function_type", "is_boundary_case", "note")
    )
    return (
        "SELECT 'android' AS platform, 'kr' AS country, app_id, coalesce(title, '') AS app_name, "
        "coalesce(description, '') AS description, coalesce(genre, '') AS genre, "
        f"CASE WHEN url <> '' THEN url ELSE {built} END AS store_url, {blank} FROM {source}"
    )


ORACLE["normalize_records"] = _with(DETAILS) + _records("details")
ORACLE["collect_then_merge"] = _with(
    APPS, DETAILS, ("collected", _records("details")),
    ("reviewed", "SELECT * REPLACE (CASE WHEN length(app_name) % 3 = 0 THEN 'EXC' ELSE '2' END AS category_id, "
                 "CASE WHEN length(app_name) % 2 = 0 THEN 'A' END AS function_type, "
                 "length(app_name) % 5 = 0 AS is_boundary_case) FROM collected"),
) + f"SELECT * FROM apps UNION ALL SELECT * FROM reviewed WHERE NOT {DROP}"
ORACLE["combined_texts"] = _with(APPS) + (
    f"SELECT app_id, coalesce(description, '') || {_text(TEXT_SEPARATOR)} || "
    "coalesce(collected_data, '') AS combined_text FROM apps"
)
ORACLE["keyword_flags"] = _with(APPS) + (
    f"SELECT app_id, {_flags(APP_TEXT)} AS minority_candidate FROM apps"
)
ORACLE["keyword_flags_conversations"] = (
    "SELECT conv_id, turn, "
    + _flags("(coalesce(text, '') || ' ' || coalesce(role, ''))")
    + " AS minority_candidate FROM conversations"
)
_TOKENS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda t: t <> '')"
ORACLE["truncation_audit"] = _with(
    ("counted", f"SELECT quality, CAST(len({_TOKENS}) AS BIGINT) AS tokens "
                "FROM documents LEFT JOIN labels USING (doc_id)"),
    ("sized", "SELECT *, greatest(tokens - (max_len - 2), 0) AS lost "
              "FROM counted, (VALUES (128), (512)) AS l(max_len)"),
) + (
    "SELECT quality, max_len, count(*) AS n, "
    "round(avg(CASE WHEN lost > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS share_cut, "
    "CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(lost) AS BIGINT) AS tokens_lost "
    "FROM sized GROUP BY quality, max_len"
)
ORACLE["token_windows"] = _with(
    ("cut", f"SELECT doc_id, list_slice({_TOKENS}, 1, 126) AS kept FROM documents"),
) + (
    "SELECT doc_id, rtrim('[CLS] ' || CASE WHEN len(kept) > 0 THEN array_to_string(kept, ' ') || ' ' "
    "ELSE '' END || '[SEP] ' || repeat('[PAD] ', 126 - len(kept))) AS input_text, "
    "128 AS length, CAST(len(kept) + 2 AS INTEGER) AS real_tokens, "
    "repeat('1', len(kept) + 2) || repeat('0', 126 - len(kept)) AS mask FROM cut"
)

# Candidate search

KEYWORDS = (
    "kw",
    "SELECT * FROM (VALUES " + ", ".join(f"({i}, {_text(k)})" for i, k in enumerate(V.SEARCH))
    + ") AS k(pos, keyword)",
)
HITS = (
    "hits",
    "SELECT pos, keyword, doc_id AS id, CAST((length(lower(text)) - "
    "length(replace(lower(text), lower(keyword), ''))) // length(keyword) AS BIGINT) AS score "
    "FROM documents JOIN kw ON contains(lower(text), lower(keyword))",
)


def _top(order_id: str) -> str:
    return (
        "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY pos "
        f"ORDER BY score DESC, {order_id}) AS INTEGER) AS hit_rank FROM hits) WHERE hit_rank <= 30"
    )


TOP = ("top", _top("id"))
TOP_TEXT = ("top", _top("CAST(id AS VARCHAR)"))
FOUND = (
    "found",
    "SELECT CAST(id AS VARCHAR) AS app_id, pos, hit_rank, keyword FROM ("
    "SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos, hit_rank) AS r FROM top) WHERE r = 1",
)
ORACLE["keyword_matches"] = _with(KEYWORDS, HITS) + "SELECT * FROM hits"
ORACLE["keyword_candidates"] = _with(KEYWORDS, HITS, TOP) + "SELECT * FROM top"
ORACLE["keyword_matches_many"] = f"""
    WITH words AS (SELECT string_split(text, ' ') AS w FROM benchmark),
    runs AS (
        SELECT DISTINCT unnest(flatten(list_transform(range({V.RUN_WORDS[0]}, {V.RUN_WORDS[1] + 1}), lambda n:
            list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))))) AS keyword
        FROM words),
    kw AS MATERIALIZED (
        SELECT CAST(row_number() OVER (ORDER BY keyword) - 1 AS INTEGER) AS pos, keyword, lower(keyword) AS needle
        FROM runs WHERE trim(keyword) <> ''),
    texts AS MATERIALIZED (SELECT doc_id, lower(text) AS low FROM documents)
    SELECT pos, keyword, doc_id AS id,
        CAST((length(low) - length(replace(low, needle, ''))) // length(needle) AS BIGINT) AS score
    FROM texts JOIN kw ON contains(low, needle)
"""
FIRST = ("firsts", "SELECT id, min(pos) AS pos FROM hits GROUP BY id")
ORACLE["first_keyword"] = _with(KEYWORDS, HITS, FIRST) + (
    "SELECT id, pos, keyword FROM firsts JOIN kw USING (pos)"
)
ORACLE["keyword_yield"] = _with(
    KEYWORDS, HITS, FIRST,
    ("n_hits", "SELECT pos, count(*) AS hits FROM hits GROUP BY pos"),
    ("n_new", "SELECT pos, count(*) AS new_ids FROM firsts GROUP BY pos"),
) + (
    "SELECT pos, keyword, coalesce(hits, 0) AS hits, coalesce(new_ids, 0) AS new_ids, "
    "CAST(sum(coalesce(new_ids, 0)) OVER (ORDER BY pos) AS BIGINT) AS ids_so_far "
    "FROM kw LEFT JOIN n_hits USING (pos) LEFT JOIN n_new USING (pos)"
)
TURN_HITS = (
    "hits",
    "SELECT pos, keyword, conv_id AS id, CAST(sum((length(lower(text)) - "
    "length(replace(lower(text), lower(keyword), ''))) // length(keyword)) AS BIGINT) AS score "
    "FROM conversations JOIN kw ON contains(lower(text), lower(keyword)) GROUP BY pos, keyword, conv_id",
)
ORACLE["keyword_candidates_repeated_ids"] = _with(KEYWORDS, TURN_HITS, TOP) + "SELECT * FROM top"
ORACLE["keyword_yield_repeated_ids"] = ORACLE["keyword_yield"].replace(HITS[1], TURN_HITS[1])
ORACLE["discovered_candidates"] = _with(KEYWORDS, HITS, TOP_TEXT, FOUND) + "SELECT * FROM found"
ORACLE["enrich_candidates"] = _with(
    KEYWORDS, HITS, TOP_TEXT, FOUND, DETAILS,
    ("wanted", "SELECT * FROM details WHERE app_id IN (SELECT app_id FROM found)"),
) + _records("wanted")
ORACLE["missing_details"] = _with(KEYWORDS, HITS, TOP_TEXT, FOUND, DETAILS) + (
    "SELECT * FROM found WHERE app_id NOT IN (SELECT app_id FROM details)"
)

# Labels, split, weights

DICTIONARY = (
    "dictionary",
    "SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS category_label "
    f"FROM (SELECT DISTINCT CAST(category_id AS INTEGER) AS category FROM apps WHERE {REAL})",
)
FUNCTION_LABEL = f"{V.FUNCTION_TRUTH} AS function_label"
ORACLE["category_dictionary"] = _with(APPS, DICTIONARY) + "SELECT * FROM dictionary"
ORACLE["encode_labels"] = _with(APPS, DICTIONARY) + (
    f"SELECT app_id, category_label, {FUNCTION_LABEL} FROM apps "
    f"LEFT JOIN dictionary ON {NUMBER} = category"
)
ORACLE["encode_single_axis"] = _with(APPS, DICTIONARY) + (
    f"SELECT app_id, {NUMBER} AS category_id, category_label FROM apps "
    f"LEFT JOIN dictionary ON {NUMBER} = category WHERE NOT {DROP_STRICT}"
)
ORACLE["decode_labels"] = _with(APPS) + (
    f"SELECT app_id, coalesce({_case(NUMBER, CATEGORY_NAMES)}, '') AS category_name, "
    f"coalesce({_case('function_type', FUNCTION_NAMES)}, '') AS function_name, "
    f"{FUNCTION_LABEL} FROM apps"
)


def _split(source: str, key: str) -> tuple[tuple[str, str], ...]:
    return (
        ("sizes", f"SELECT category_id, count(*) AS n FROM {source} GROUP BY category_id"),
        ("totals", "SELECT sum(n) AS total, sum(n) - CAST(ceil(CAST(sum(n) AS DOUBLE) "
                   "* CAST(0.2 AS DOUBLE)) AS HUGEINT) AS train FROM sizes"),
        ("quotas", "SELECT category_id, n, train, (n * train) // total AS base, "
                   "(n * train) % total AS rest FROM sizes, totals"),
        ("dealt", "SELECT *, train - sum(base) OVER () AS spare, "
                  "row_number() OVER (ORDER BY rest DESC, category_id) AS place FROM quotas"),
        ("allocation", "SELECT category_id, n, CAST(base + CASE WHEN place <= spare THEN 1 ELSE 0 END "
                       "AS BIGINT) AS n_train FROM dealt"),
        ("placed", "SELECT s.*, place <= n_train AS is_train FROM ("
                   "SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY "
                   f"md5(concat(CAST({key} AS VARCHAR), '|42')), CAST({key} AS VARCHAR)) AS place "
                   f"FROM {source}) AS s JOIN allocation USING (category_id)"),
    )


KNOWN = ("known", "SELECT * FROM apps WHERE category_id IS NOT NULL")
ORACLE["split_allocation"] = _with(APPS, KNOWN, *_split("known", "app_id")) + (
    "SELECT category_id, n, n_train, n - n_train AS n_test FROM allocation"
)
ORACLE["stratified_split"] = _with(APPS, KNOWN, *_split("known", "app_id")) + (
    "SELECT app_id, category_id, is_train FROM placed"
)


ORACLE["split_preconditions"] = _with(
    ("sizes", f"SELECT {V.SPLIT_TROUBLE} AS label, count(*) AS n FROM documents GROUP BY 1"),
    ("sides", f"SELECT sum(n) AS total, CAST(ceil(CAST(sum(n) AS DOUBLE) * CAST({V.TROUBLE_TEST_SIZE} AS DOUBLE)) "
              "AS BIGINT) AS test, count(*) AS classes FROM sizes"),
) + (
    "SELECT 'class_missing' AS rule, NULL AS class, n AS rows, CAST(0 AS BIGINT) AS needed FROM sizes WHERE label IS NULL "
    "UNION ALL SELECT 'class_too_small', label, n, 2 FROM sizes WHERE label IS NOT NULL AND n < 2 "
    "UNION ALL SELECT 'no_room_for_training', NULL, CAST(total - test AS BIGINT), classes FROM sides WHERE total - test < classes "
    "UNION ALL SELECT 'no_room_for_test', NULL, test, classes FROM sides WHERE test < classes"
)


def _balance(axis: str, label: str, weighted: bool) -> str:
    rows = "CAST(sum(count_if(is_train)) OVER () AS DOUBLE) / count(*) OVER ()" if weighted else (
        "CAST(count_if(is_train) AS DOUBLE)")
    return (
        f"SELECT '{axis}' AS axis, CAST({label} AS INTEGER) AS class, CAST(count_if(is_train) AS BIGINT) AS train_rows, "
        f"round({rows}, 3) AS predicted_rows, CAST(count_if(NOT is_train) AS BIGINT) AS test_rows "
        f"FROM placed WHERE {label} IS NOT NULL GROUP BY {label}"
    )


def _labelled(category: str) -> tuple[str, str]:
    return "known", f"SELECT doc_id, {category} AS category_id, toxic FROM documents JOIN labels USING (doc_id)"


ORACLE["model_settings"] = _with(_labelled("toxic"), *_split("known", "doc_id"), (
    "sides",
    "SELECT count_if(is_train) AS train, count_if(NOT is_train) AS test, "
    "sum(CAST('0x' || substr(md5(concat_ws('|', CAST(doc_id AS VARCHAR), CAST(category_id AS VARCHAR), "
    "CAST(is_train AS VARCHAR))), 1, 13) AS BIGINT)) AS h FROM placed",
)) + " UNION ALL ".join(
    f"SELECT '{name}' AS name, {value} AS value FROM sides" for name, value in {
        "key": "'doc_id'", "test_size": "'0.2'", "seed": "'42'", "num_features": "'1024'", "max_iter": "'3'",
        "tolerance": "'1e-08'", "reg": "'0.01'", "train_rows": "CAST(train AS VARCHAR)",
        "test_rows": "CAST(test AS VARCHAR)", "split_hash": "CAST(h AS VARCHAR)",
    }.items()
)
ORACLE["train_two_heads"] = _with(_labelled("quality"), *_split("known", "doc_id")) + (
    f"{_balance('category', 'category_id', False)} UNION ALL {_balance('function', 'toxic', False)}")
ORACLE["train_weighted_text_head"] = _with(_labelled("toxic"), *_split("known", "doc_id")) + (
    _balance("category", "category_id", True))
ORACLE["train_weighted_head"] = _with(VECTORS, *_split(VECTORS[0], "vec_id")) + (
    _balance("category", "category_label", True))
ORACLE["class_weights"] = _with(
    APPS, KNOWN, DICTIONARY, *_split("known", "app_id"),
    ("counted", "SELECT category_label, count(*) AS n FROM placed "
                f"JOIN dictionary ON {NUMBER} = category WHERE is_train GROUP BY category_label"),
) + (
    "SELECT category_label, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 6) "
    "AS weight FROM counted"
)

# Diagnostics


def _axes(source: str, axes: list[tuple[str, str, str]], by: str = "") -> str:
    """Truth and prediction of every axis, one under the other."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS axis, {by}{truth} AS truth, {pred} AS predicted FROM {source} "
        f"WHERE {truth} IS NOT NULL"
        for name, truth, pred in axes
    )


def _report(pairs: str, by: str = "") -> tuple[tuple[str, str], ...]:
    keys = f"axis, {by}"
    same = " AND ".join(
        f"c.{k.strip()} = t.{k.strip()}" for k in f"axis, {by}".split(",") if k.strip()
    )
    return (
        ("classes", f"SELECT {keys} truth AS class FROM {pairs} UNION "
                    f"SELECT {keys} predicted FROM {pairs}"),
        ("tallies", f"SELECT {', '.join('c.' + k.strip() for k in keys.split(',') if k.strip())}, class, "
                    "count(*) FILTER (WHERE truth = class) AS support, "
                    "count(*) FILTER (WHERE predicted = class) AS predicted_rows, "
                    "count(*) FILTER (WHERE truth = class AND predicted = class) AS hits "
                    f"FROM classes AS c JOIN {pairs} AS t ON {same} GROUP BY ALL"),
        ("report", f"SELECT {keys} class, "
                   "CASE WHEN predicted_rows > 0 THEN CAST(hits AS DOUBLE) / predicted_rows ELSE 0 END AS precision, "
                   "CASE WHEN support > 0 THEN CAST(hits AS DOUBLE) / support ELSE 0 END AS recall, "
                   "CAST(2 * hits AS DOUBLE) / (support + predicted_rows) AS f1, "
                   "support, predicted_rows, hits FROM tallies"),
        ("summary", f"SELECT {keys} CAST(sum(hits) AS DOUBLE) / sum(support) AS accuracy, "
                    "avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1, "
                    "sum(precision * support) / sum(support) AS weighted_precision, "
                    "sum(recall * support) / sum(support) AS weighted_recall, "
                    "sum(f1 * support) / sum(support) AS weighted_f1, "
                    "CAST(sum(support) AS BIGINT) AS support FROM report GROUP BY ALL"),
    )


JUDGED_AXES = [("quality", "quality", "quality_pred"), ("toxic", "toxic", "toxic_pred")]
JUDGED_PAIRS = ("pairs", _axes("judged", JUDGED_AXES))
ROUNDED_REPORT = (
    "SELECT axis, class, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1, support, predicted_rows, hits FROM report"
)
ORACLE["confusion"] = _with(
    LABELLED, JUDGED, ("pairs", _axes("judged", JUDGED_AXES, "lang, "))
) + (
    "SELECT axis, lang, truth, predicted, count(*) AS n FROM pairs GROUP BY ALL UNION ALL "
    "SELECT axis, 'all', truth, predicted, count(*) FROM pairs GROUP BY axis, truth, predicted"
)
ORACLE["class_report"] = _with(LABELLED, JUDGED, JUDGED_PAIRS, *_report("pairs")) + ROUNDED_REPORT
ORACLE["report_summary"] = _with(LABELLED, JUDGED, JUDGED_PAIRS, *_report("pairs")) + (
    "SELECT axis, round(accuracy, 6) AS accuracy, round(macro_precision, 6) AS macro_precision, "
    "round(macro_recall, 6) AS macro_recall, round(macro_f1, 6) AS macro_f1, "
    "round(weighted_precision, 6) AS weighted_precision, round(weighted_recall, 6) AS weighted_recall, "
    "round(weighted_f1, 6) AS weighted_f1, support FROM summary"
)
ORACLE["macro_scores"] = _with(LABELLED, JUDGED, JUDGED_PAIRS, *_report("pairs")) + (
    "SELECT round(avg(macro_f1), 6) AS avg_macro_f1 FROM summary"
)
_ROW = "'%14s %9.2f %9.2f %9.2f %9d'"
_NAME = (
    "CASE WHEN axis = 'toxic' THEN CASE class WHEN 0 THEN 'clean' ELSE 'toxic' END "
    "ELSE CAST(class AS VARCHAR) END"
)
ORACLE["report_text"] = _with(
    LABELLED, JUDGED, JUDGED_PAIRS, *_report("pairs"),
    ("lines",
     "SELECT axis, 0 AS part, 0 AS class, printf('%14s %9s %9s %9s %9s', '', 'precision', 'recall', "
     "'f1-score', 'support') AS line FROM summary UNION ALL "
     f"SELECT axis, 1, class, printf({_ROW}, {_NAME}, precision, recall, f1, support) FROM report "
     "UNION ALL SELECT axis, 2, 0, printf('%14s %9s %9s %9.2f %9d', 'accuracy', '', '', accuracy, "
     "support) FROM summary UNION ALL "
     f"SELECT axis, 3, 0, printf({_ROW}, 'macro avg', macro_precision, macro_recall, macro_f1, support) "
     "FROM summary UNION ALL "
     f"SELECT axis, 4, 0, printf({_ROW}, 'weighted avg', weighted_precision, weighted_recall, "
     "weighted_f1, support) FROM summary"),
) + (
    "SELECT axis, CAST(row_number() OVER (PARTITION BY axis ORDER BY part, class) - 1 AS INTEGER) "
    "AS line_no, line FROM lines"
)
_LONG_NAME = (
    "CASE axis WHEN 'toxic' THEN CASE class WHEN 0 THEN 'clean' ELSE 'toxic' END "
    "ELSE CASE class WHEN 0 THEN 'of no particular use' ELSE 'good' END END"
)
_CELLS = "printf('%9.2f %9.2f %9.2f %9d', {}, {}, {}, support)"


def _avg(kind: str) -> str:
    return _CELLS.format(*[f"{kind}_{c}" for c in ("precision", "recall", "f1")])


ORACLE["report_text_slices"] = _with(
    LABELLED, JUDGED, JUDGED_PAIRS, *_report("pairs"),
    ("cells",
     "SELECT axis, 1 AS part, 0 AS place, '' AS name, printf('%9s %9s %9s %9s', 'precision', 'recall', 'f1-score', "
     "'support') AS cells FROM summary UNION ALL SELECT axis, 2, 0, '', NULL FROM summary UNION ALL "
     f"SELECT axis, 3, class, {_LONG_NAME}, {_CELLS.format('precision', 'recall', 'f1')} FROM report UNION ALL "
     "SELECT axis, 4, 0, '', NULL FROM summary UNION ALL "
     "SELECT axis, 5, 0, 'accuracy', printf('%9s %9s %9.2f %9d', '', '', accuracy, support) FROM summary UNION ALL "
     f"SELECT axis, 6, 0, 'macro avg', {_avg('macro')} FROM summary UNION ALL "
     f"SELECT axis, 7, 0, 'weighted avg', {_avg('weighted')} FROM summary UNION ALL "
     "SELECT axis, 8, 0, '', NULL FROM summary"),
    ("wide", "SELECT *, max(length(name)) OVER (PARTITION BY axis) AS width FROM cells"),
    ("parts", "SELECT doc_id % 10 = 9 AS exc, toxic AS truth, toxic_pred AS predicted FROM judged WHERE toxic IS NOT NULL"),
    ("classes_in", "SELECT DISTINCT exc, truth AS class FROM parts"),
    ("f1s", "SELECT c.exc, c.class, count(*) FILTER (WHERE truth = class) AS support, "
            "CAST(2 * count(*) FILTER (WHERE truth = class AND predicted = class) AS DOUBLE) / "
            "(count(*) FILTER (WHERE truth = class) + count(*) FILTER (WHERE predicted = class)) AS f1 "
            "FROM classes_in AS c JOIN parts AS p ON c.exc = p.exc GROUP BY ALL"),
    ("sliced", "SELECT exc, sum(support) AS n, avg(f1) AS macro_f1 FROM f1s GROUP BY exc"),
    ("lines",
     "SELECT 0 AS section, 0 AS part, 0 AS place, '=== quality ===' AS line UNION ALL "
     "SELECT 1, 0, 0, '=== toxic: all rows ===' UNION ALL SELECT 2, 0, 0, '=== slices ===' UNION ALL "
     "SELECT CASE axis WHEN 'quality' THEN 0 ELSE 1 END, part, place, "
     "coalesce(lpad(name, CAST(width AS INTEGER), ' ') || '  ' || cells, '') FROM wide UNION ALL "
     "SELECT 2, 1, CAST(exc AS INTEGER), printf('[%s] n=%d, macro F1=%.4f', "
     "CASE WHEN exc THEN 'sentinel' ELSE 'no sentinel' END, CAST(n AS BIGINT), macro_f1) FROM sliced"),
) + "SELECT CAST(row_number() OVER (ORDER BY section, part, place) - 1 AS INTEGER) AS line_no, line FROM lines"
_SLICED = (
    "SELECT CASE WHEN coalesce(category_id = 'EXC', false) THEN 'EXC' ELSE 'real' END AS slice, "
    f"{V.FUNCTION_TRUTH} AS truth, {V.FUNCTION_RULE} AS pred FROM apps"
)
ORACLE["slice_macro_f1"] = _with(
    APPS,
    ("sliced", _SLICED),
    ("doubled", "SELECT * FROM sliced UNION ALL SELECT 'all' AS slice, truth, pred FROM sliced"),
    ("pairs", _axes("doubled", [("function", "truth", "pred")], "slice, ")),
    *_report("pairs", "slice, "),
) + (
    "SELECT axis, slice, CAST(sum(support) AS BIGINT) AS n, round(avg(f1), 6) AS macro_f1 "
    "FROM report WHERE support > 0 GROUP BY axis, slice"
)


def _nll(logits: str, label: str) -> str:
    return (
        f"CASE WHEN {label} IS NOT NULL THEN ln(list_sum(list_transform({logits}, "
        f"lambda x: exp(x - list_max({logits}))))) + list_max({logits}) - {logits}[{label} + 1] END"
    )


LOSSES = (
    "losses",
    f"SELECT category_label, {_nll('lc', 'category_label')} AS c, {_nll('lf', 'function_label')} AS f "
    "FROM logits",
)
ORACLE["two_axis_log_loss"] = _with(VECTORS, LOGITS, LOSSES) + (
    "SELECT round(avg(c), 6) AS category_loss, count(c) AS category_rows, "
    "round(avg(f), 6) AS function_loss, count(f) AS function_rows, round(avg(c) + avg(f), 6) AS loss "
    "FROM losses"
)
ORACLE["weighted_log_loss"] = _with(
    VECTORS, LOGITS, LOSSES,
    ("sizes", "SELECT category_label, count(*) AS n FROM vectors WHERE category_label IS NOT NULL "
              "GROUP BY category_label"),
    ("weights", "SELECT category_label, CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n) AS w "
                "FROM sizes"),
) + "SELECT round(sum(w * c) / sum(w), 6) AS loss, count(c) AS rows FROM losses JOIN weights USING (category_label)"

ORACLE["evaluate_holdout"] = _with(
    *SCORING,
    *_split("scored", "vec_id"),
    ("held_out", "SELECT * FROM placed WHERE NOT is_train"),
    ("pairs", _axes("held_out", [
        ("category", "category_label", "category_pred"),
        ("function", "function_label", "function_pred"),
    ])),
    *_report("pairs"),
) + ROUNDED_REPORT

# Run logs

_RUNS = (
    LABELLED,
    ("moves", f"SELECT lang AS run, epoch, quality, toxic, {V.EPOCH_QUALITY} AS quality_pred, "
              f"{V.EPOCH_TOXIC} AS toxic_pred FROM labelled, (SELECT unnest(range(1, {V.EPOCHS + 1})) AS epoch)"),
    ("pairs", _axes("moves", JUDGED_AXES, "run, epoch, ")),
    *_report("pairs", "run, epoch, "),
    ("wide", "SELECT run, CAST(epoch AS INTEGER) AS epoch, "
             "max(accuracy) FILTER (WHERE axis = 'quality') AS acc1, "
             "max(macro_f1) FILTER (WHERE axis = 'quality') AS f1_1, "
             "max(accuracy) FILTER (WHERE axis = 'toxic') AS acc2, "
             "max(macro_f1) FILTER (WHERE axis = 'toxic') AS f1_2 FROM summary GROUP BY run, epoch"),
    ("epochs", f"SELECT run, epoch, {V.EPOCHS} AS max_epochs, " + ", ".join(
        f"CAST(printf('%.4f', {value}) AS DOUBLE) AS {name}" for name, value in {
            "loss": "2 - acc1 - acc2", "acc1": "acc1", "f1_1": "f1_1", "acc2": "acc2",
            "f1_2": "f1_2", "avg_f1": "(f1_1 + f1_2) / 2",
        }.items()) + " FROM wide"),
    ("marked", "SELECT *, avg_f1 > coalesce(max(avg_f1) OVER (PARTITION BY run ORDER BY epoch "
               "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS is_best FROM epochs"),
    ("streaks", "SELECT *, CAST(epoch - coalesce(max(CASE WHEN is_best THEN epoch END) OVER "
                "(PARTITION BY run ORDER BY epoch), 0) AS INTEGER) AS streak FROM marked"),
    ("stopped", "SELECT *, min(CASE WHEN streak >= 5 THEN epoch END) OVER "
                "(PARTITION BY run ORDER BY epoch) AS stop_at FROM streaks"),
    ("trained", "SELECT *, stop_at IS NOT NULL AS stops FROM stopped "
                "WHERE stop_at IS NULL OR epoch <= stop_at"),
    ("best", "SELECT run, max(epoch) AS epochs, max(epoch) FILTER (WHERE is_best) AS best_epoch, "
             "max(avg_f1) FILTER (WHERE is_best) AS best_score, "
             "max(epoch) FILTER (WHERE stops) AS stop_epoch FROM trained GROUP BY run"),
)
ORACLE["epoch_log"] = _with(*_RUNS) + "SELECT * FROM epochs"
ORACLE["early_stopping"] = _with(*_RUNS) + (
    "SELECT run, epoch, avg_f1, is_best, streak, stops FROM trained"
)
ORACLE["best_checkpoint"] = _with(*_RUNS) + "SELECT * FROM best"
ORACLE["select_run"] = _with(*_RUNS) + "SELECT * FROM best ORDER BY best_score DESC, run LIMIT 1"


def _runs(epochs: str) -> tuple[tuple[str, str], ...]:
    """The same steps over other epochs, made from those of `_RUNS` under the name `logged`."""
    out = []
    for name, sql in _RUNS:
        out.append(("logged", sql) if name == "epochs" else (name, sql))
        if name == "epochs":
            out.append(("epochs", epochs))
    return tuple(out)


ORACLE["early_stopping_restarts"] = _with(*_runs(
    f"SELECT run || '#1' AS run, * EXCLUDE (run) FROM logged WHERE epoch <= {V.RESTART} "
    "UNION ALL SELECT run || '#2', * EXCLUDE (run) FROM logged"
)) + (
    "SELECT split_part(run, '#', 1) AS run, CAST(split_part(run, '#', 2) AS INTEGER) AS segment, "
    "epoch, avg_f1, is_best, streak, stops FROM trained"
)
ORACLE["one_axis_checkpoints"] = _with(*_runs(
    "SELECT run || '#2' AS run, epoch, avg_f1 FROM logged UNION ALL SELECT run || '#1', epoch, f1_1 FROM logged"
)) + (
    "SELECT split_part(run, '#', 1) AS run, 1 AS segment, CAST(split_part(run, '#', 2) AS INTEGER) AS axes, "
    "* EXCLUDE (run) FROM best"
)
