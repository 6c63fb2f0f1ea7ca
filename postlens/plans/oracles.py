"""The catalog queries as independent SQL for DuckDB, over the tables as views.

The SQL takes another way than the Spark queries where it can: windows by position in place of neighbour arrays, joins
in place of projections, filtered counts in place of one scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from postlens.params import AFFECTS
from postlens.plans.catalog import AFFECT_WORDS, DEVICES, KEYWORDS, MANY_KEYWORDS, MASKED, RAW_TERMS, RULES, SENTIMENT, SYMBOLS, VALENCES


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def quotes(values: Iterable[str]) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


POSTS = "posts AS (SELECT doc_id AS id, source AS author, lang AS subreddit, n_chars AS score, text FROM documents)"
VALENCE_ROWS = ", ".join(f"({quote(t)}, {v}::DOUBLE)" for t, v in VALENCES.items())
AFFECT_ROWS = ", ".join(f"({quote(t)}, {quote(a)}, {AFFECTS.index(a)})" for t, names in AFFECT_WORDS.items() for a in names)

STATUSES = """
statuses AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'en' ELSE lower(o_orderstatus) END AS lang,
    o_orderpriority AS own_text, CASE WHEN c_nationkey > 12 THEN c_mktsegment END AS shared_text,
    c_name AS screen_name, floor(c_acctbal)::BIGINT AS followers_count, c_nationkey::BIGINT AS friends_count,
    floor(o_totalprice / 50000)::BIGINT AS statuses_count, c_mktsegment AS user_lang,
    CASE WHEN c_acctbal >= 0 THEN n_name END AS location, r_name AS time_zone, o_orderdate,
    CASE WHEN o_orderstatus <> 'O' THEN [c_mktsegment, o_orderpriority] ELSE [c_mktsegment] END AS hashtags,
    n_name, CASE WHEN c_acctbal > 5000 THEN 'img/' || c_name ELSE '' END AS media_urls
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey),
english AS (SELECT * FROM statuses WHERE lang = 'en')
"""
PROJECTED = "id, lang, screen_name, followers_count, friends_count, statuses_count, location, time_zone"

NORMALIZED = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"


def rule_case(column: str = "normalized") -> str:
    def any_of(words: Iterable[str]) -> str:
        return " OR ".join(f"contains({column}, {quote(w)})" for w in words)

    cases = "".join(f" WHEN {any_of(words)} THEN {quote(label)}" for label, words in RULES.rules)
    return (
        f"CASE WHEN {column} = '' THEN {quote(RULES.default)}{cases} "
        f"WHEN {any_of(RULES.fallback)} THEN {quote(RULES.fallback_label)} ELSE {quote(RULES.default)} END"
    )


LABELED = f"""{POSTS},
labeled AS (SELECT *, {rule_case()} AS weak_label FROM (SELECT *, {NORMALIZED} AS normalized FROM posts))"""


def counted(terms: Iterable[str], source: str, value: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {quote(t)} AS keyword, (SELECT count(*) FROM {source} WHERE contains({value}, {quote(t)})) AS count" for t in terms
    )
    return f"SELECT keyword, count FROM ({rows})"


def grouped(keys: str, source: str, k: int, count_name: str = "count") -> str:
    return f"SELECT {keys}, count(*) AS {count_name} FROM {source} GROUP BY {keys} ORDER BY {count_name} DESC, {keys} LIMIT {k}"


def labeled_as(score: str) -> str:
    return f"CASE WHEN {score} >= 0.05 THEN 'positive' WHEN {score} <= -0.05 THEN 'negative' ELSE 'neutral' END"


PLAIN = f"""{POSTS},
lexicon(token, valence) AS (VALUES {VALENCE_ROWS}),
tokens AS (SELECT id, unnest(regexp_extract_all(lower(text), '[A-Za-z'']+')) AS token FROM posts),
sizes AS (SELECT id, count(*) AS n FROM tokens GROUP BY id),
sums AS (SELECT id, sum(valence) AS total, count(*) FILTER (valence > 0) AS pos, count(*) FILTER (valence < 0) AS neg
  FROM tokens JOIN lexicon USING (token) GROUP BY id),
plain AS (SELECT p.id, author, subreddit,
    coalesce(round(total / sqrt(total * total + 15.0::DOUBLE), 4), 0.0::DOUBLE) AS sentiment_compound,
    coalesce(round(pos / n, 4), 0.0::DOUBLE) AS sentiment_pos,
    coalesce(round((n - pos - neg) / n, 4), 1.0::DOUBLE) AS sentiment_neu,
    coalesce(round(neg / n, 4), 0.0::DOUBLE) AS sentiment_neg
  FROM posts p LEFT JOIN sums s ON p.id = s.id LEFT JOIN sizes z ON p.id = z.id)"""

S = SENTIMENT
PUNCTUATION = quote("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def upper_word(column: str) -> str:
    return f"coalesce(regexp_matches({column}, '\\p{{Lu}}') AND NOT regexp_matches({column}, '\\p{{Ll}}|\\p{{Lt}}'), false)"


def boost(k: int, share: float) -> str:
    """Degree word k places before: the new value of v."""
    weight = (
        f"CASE WHEN b{k} IN {quotes(S.boosters_up)} THEN {S.booster_weight}::DOUBLE "
        f"WHEN b{k} IN {quotes(S.boosters_down)} THEN -{S.booster_weight}::DOUBLE END"
    )
    caps = f"CASE WHEN u{k} AND caps THEN CASE WHEN v > 0 THEN {S.caps_weight}::DOUBLE ELSE -{S.caps_weight}::DOUBLE END ELSE 0.0::DOUBLE END"
    return (
        f"CASE WHEN reach{k} AND ({weight}) IS NOT NULL "
        f"THEN v + (CASE WHEN v < 0 THEN -({weight}) ELSE ({weight}) END + {caps}) * {share}::DOUBLE ELSE v END"
    )


def negate(k: int) -> str:
    links, (without, doubt) = quotes(S.never_links), S.doubt
    special = {
        1: "",
        2: f"WHEN b2 = {quote(S.never)} AND b1 IN {links} THEN v * {S.never_weight}::DOUBLE "
        f"WHEN b2 = {quote(without)} AND b1 = {quote(doubt)} THEN v ",
        3: f"WHEN (b3 = {quote(S.never)} AND b2 IN {links}) OR b1 IN {links} THEN v * {S.never_weight}::DOUBLE "
        f"WHEN b3 = {quote(without)} AND (b2 = {quote(doubt)} OR b1 = {quote(doubt)}) THEN v ",
    }[k]
    return (
        f"CASE WHEN NOT reach{k} THEN v {special}"
        f"WHEN b{k} IN {quotes(S.negations)} OR contains(b{k}, 'n''t') THEN v * ({S.negation_weight})::DOUBLE ELSE v END"
    )


def idiom(*parts: str) -> str:
    whole = " || ' ' || ".join(parts)
    cases = " ".join(f"WHEN {quote(i)} THEN ({w})::DOUBLE" for i, w in S.idioms.items())
    return f"CASE {whole} {cases} END"


def phrase_hit(*parts: str) -> str:
    whole = " || ' ' || ".join(parts)
    return f"CASE WHEN {whole} IN {quotes(S.booster_phrases_down)} THEN {S.booster_weight}::DOUBLE ELSE 0.0::DOUBLE END"


STEPS = [
    f"CASE WHEN u0 AND caps THEN CASE WHEN v > 0 THEN v + {S.caps_weight}::DOUBLE ELSE v - {S.caps_weight}::DOUBLE END ELSE v END",
    boost(1, 1.0),
    negate(1),
    boost(2, S.second_word_share),
    negate(2),
    boost(3, S.third_word_share),
    negate(3),
    f"CASE WHEN reach3 THEN coalesce({idiom('b1', 'w0')}, {idiom('b2', 'b1', 'w0')}, {idiom('b2', 'b1')}, "
    f"{idiom('b3', 'b2', 'b1')}, {idiom('b3', 'b2')}, v) ELSE v END",
    f"CASE WHEN reach3 THEN coalesce({idiom('w0', 'a1')}, v) ELSE v END",
    f"CASE WHEN reach3 THEN coalesce({idiom('w0', 'a1', 'a2')}, v) ELSE v END",
    f"CASE WHEN reach3 THEN v - {phrase_hit('b3', 'b2', 'b1')} - {phrase_hit('b3', 'b2')} - {phrase_hit('b2', 'b1')} ELSE v END",
    f"CASE WHEN reach1 AND b1 = {quote(S.least)} AND coalesce(b2 NOT IN {quotes(S.least_lead)}, true) "
    f"THEN v * ({S.negation_weight})::DOUBLE ELSE v END",
    f"CASE WHEN i < turn THEN v * {S.before_contrast}::DOUBLE WHEN i > turn THEN v * {S.after_contrast}::DOUBLE ELSE v END",
]


def ruled(posts: str = POSTS) -> str:
    # Each step uses the former value several times: materialised, so that it is not written out again and again.
    steps = ""
    for number, step in enumerate(STEPS):
        steps += f",\nstep{number + 1} AS MATERIALIZED (SELECT * EXCLUDE (v), {step} AS v FROM step{number})"
    lags = ", ".join(f"lag(w0, {k}) OVER w AS b{k}, coalesce(lag(u0, {k}) OVER w, false) AS u{k}" for k in (1, 2, 3))
    leads = ", ".join(f"lead(w0, {k}) OVER w AS a{k}" for k in (1, 2))
    known = "(SELECT token FROM lexicon)"
    return f"""{posts},
lexicon(token, valence) AS (VALUES {VALENCE_ROWS}),
cut AS (SELECT id, regexp_extract_all(text, '[^\\s]+') AS ws FROM posts),
raw AS (SELECT id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM cut),
words AS (SELECT id, i, CASE WHEN length(trim(word, {PUNCTUATION})) <= 2 THEN word ELSE trim(word, {PUNCTUATION}) END AS word FROM raw),
flat AS (SELECT id, i, lower(word) AS w0, {upper_word('word')} AS u0 FROM words),
marks AS (SELECT id, length(text) - length(replace(text, '!', '')) AS ex, length(text) - length(replace(text, '?', '')) AS qu FROM posts),
whole AS (SELECT f.id, count(*) AS n, bool_or(u0) AND bool_or(NOT u0) AS caps, min(i) FILTER (w0 = {quote(S.contrast)}) AS turn,
    any_value(least(ex, {S.exclamation_most}) * {S.exclamation_weight}::DOUBLE
      + CASE WHEN qu <= 1 THEN 0.0::DOUBLE WHEN qu <= {S.question_most} THEN qu * {S.question_weight}::DOUBLE ELSE {S.question_top}::DOUBLE END) AS e
  FROM flat f JOIN marks m ON f.id = m.id GROUP BY f.id),
near AS (SELECT *, {lags}, {leads} FROM flat WINDOW w AS (PARTITION BY id ORDER BY i)),
hits AS (SELECT near.*, valence, caps, turn, e, n,
    b1 IS NOT NULL AND b1 NOT IN {known} AS reach1, b2 IS NOT NULL AND b2 NOT IN {known} AS reach2,
    b3 IS NOT NULL AND b3 NOT IN {known} AS reach3
  FROM near JOIN lexicon ON w0 = token JOIN whole ON near.id = whole.id
  WHERE w0 NOT IN {quotes([*S.boosters_up, *S.boosters_down])}
    AND NOT (w0 = {quote(S.not_a_booster[0])} AND coalesce(a1, '') = {quote(S.not_a_booster[1])})),
step0 AS MATERIALIZED (SELECT *, CASE
    WHEN coalesce(b1 = {quote(S.no_word)}, false) OR coalesce(b2 = {quote(S.no_word)}, false)
      OR coalesce(b3 = {quote(S.no_word)} AND b1 IN {quotes(S.no_links)}, false) THEN valence * ({S.negation_weight})::DOUBLE
    WHEN w0 = {quote(S.no_word)} AND coalesce(a1 IN {known}, false) THEN 0.0::DOUBLE ELSE valence END AS v FROM hits){steps},
sums AS (SELECT id, any_value(e) AS e, any_value(n) AS n, round(sum(v), 9) AS total,
    round(sum(CASE WHEN v > 0 THEN v + 1 ELSE 0.0::DOUBLE END), 9) AS pos,
    round(sum(CASE WHEN v < 0 THEN 1 - v ELSE 0.0::DOUBLE END), 9) AS neg, count(*) FILTER (v <> 0) AS signed
  FROM step{len(STEPS)} GROUP BY id),
parts AS (SELECT id, total + sign(total) * e AS total, CASE WHEN pos > neg THEN pos + e ELSE pos END AS pos,
    CASE WHEN pos < neg THEN neg + e ELSE neg END AS neg, n - signed AS neu FROM sums),
ruled AS (SELECT p.id, author, subreddit, score, text,
    coalesce(round(total / sqrt(total * total + {S.alpha}::DOUBLE), 4), 0.0::DOUBLE) AS sentiment_compound,
    coalesce(round(pos / (pos + neg + neu), 3), 0.0::DOUBLE) AS sentiment_pos,
    coalesce(round(neu / (pos + neg + neu), 3), 1.0::DOUBLE) AS sentiment_neu,
    coalesce(round(neg / (pos + neg + neu), 3), 0.0::DOUBLE) AS sentiment_neg
  FROM posts p LEFT JOIN parts ON p.id = parts.id)"""


RULED = ruled()


def spelled() -> str:
    """The text with one symbol after the other replaced: where a blank or the start stands before it, then elsewhere."""
    value = "text"
    for symbol, words in SYMBOLS.items():
        value = f"replace(regexp_replace({value}, '(^| )[{symbol}]', '\\1{words}', 'g'), {quote(symbol)}, {quote(' ' + words)})"
    return value


SPELLED_POSTS = f"posts AS (SELECT doc_id AS id, source AS author, lang AS subreddit, n_chars AS score, {spelled()} AS text FROM documents)"
MANY = ", ".join(f"({quote(w)})" for w in dict.fromkeys(MANY_KEYWORDS))
#: Path, kind and type of event of the fields of the records whose shape changes.
SHAPES = (
    ("$.user", "BIGINT", "click"), ("$.user", "STRING", "view"), ("$.user", "OBJECT", "purchase"), ("$.user.n", "BIGINT", "purchase"),
    ("$.user", "ARRAY", "signup"), ("$.user[]", "STRING", "signup"), ("$.user[]", "BIGINT", "signup"), ("$.user[]", "VOID", "signup"),
)


def emotions(ties: str = "place") -> str:
    order = "n DESC, place, affect" if ties == "place" else "n DESC, rank"
    return f"""affects(token, affect, rank) AS (VALUES {AFFECT_ROWS}),
affect_lists AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[A-Za-z'']+') AS ts FROM documents),
affect_places AS (SELECT id, unnest(ts) AS token, generate_subscripts(ts, 1) AS place FROM affect_lists),
affect_rows AS (SELECT id, affect, rank, count(*) AS n, min(place) AS place FROM affect_places JOIN affects USING (token)
  GROUP BY id, affect, rank),
emotions AS (SELECT doc_id AS id, coalesce(top, 'neutral') AS top_emotion, coalesce(scores, '{{}}') AS emotion_scores
  FROM documents LEFT JOIN (SELECT id, arg_min(affect, number) AS top,
      '{{' || string_agg('"' || affect || '":' || n, ',' ORDER BY number) || '}}' AS scores
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS number FROM affect_rows) GROUP BY id) e
  ON doc_id = e.id)"""


ANNOTATIONS = """annotations AS (SELECT doc_id::VARCHAR AS id, 'q' || quality AS information_integrity, toxic = 1 AS linguistic_bias,
  quality = 1 AS casualty, quality = 0 AS damage, toxic = 1 AS recovery FROM labels)"""
FIRST = "split_part(text, chr(10), 1)"
SUBMISSIONS = f"""submissions AS (SELECT doc_id::VARCHAR AS id, {FIRST} AS title, substr(text, length({FIRST}) + 2) AS selftext,
  lang AS subreddit, CASE WHEN source <> 'src1' THEN source END AS author, CASE WHEN lang <> 'fr' THEN n_chars END AS score,
  CASE WHEN lang = 'en' THEN '/p/' || doc_id ELSE '' END AS permalink, '/full/' || doc_id AS full_link,
  CASE WHEN lang <> 'es' THEN lang = 'en' END AS is_self FROM documents)"""
TRIMMED = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
LAST_TURNS = f"""last_turns AS (SELECT conv_id::VARCHAR AS id,
  {TRIMMED.format("CASE WHEN text = '' THEN role ELSE role || chr(10) || text END")} AS text
  FROM conversations c WHERE turn = (SELECT max(turn) FROM conversations d WHERE d.conv_id = c.conv_id))"""

# An event as one line of JSON.
RECORD = """('{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":' || CAST(to_json(props) AS VARCHAR) || '}')"""
LINES = "CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 2) ELSE props END"
DOC_TAGS = "list_distinct(regexp_extract_all(text, '[A-Za-z]{8,}'))"
DOC_NAMES = "list_distinct(regexp_extract_all(text, '[A-Z][a-z]{4,}'))"
DOC_URLS = "CASE WHEN contains(text, 'http') THEN list_distinct(regexp_extract_all(text, 'https?://[A-Za-z0-9./_-]+')) ELSE [] END"
SPLIT = "CASE WHEN ('0x' || substr(md5('42:' || id), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END"
GUESSED = f"""{LABELED},
guessed AS (SELECT subreddit AS label, CASE weak_label WHEN 'de_func' THEN 'de' WHEN 'es_suffix' THEN 'es' ELSE 'en' END AS prediction
  FROM labeled)"""

TURNS = "posts AS (SELECT row_number() OVER () AS id, conv_id AS author, turn AS subreddit, text FROM conversations)"
TURN_EMOTIONS = emotions().replace("doc_id AS id, regexp", "id, regexp").replace("doc_id AS id, coalesce", "posts.id AS id, coalesce").replace("FROM documents", "FROM posts").replace("ON doc_id = e.id", "ON posts.id = e.id")
TITLED = f"""SELECT doc_id::VARCHAR AS id, source AS author, lang AS subreddit, n_chars AS score, {TRIMMED.format('text')} AS text
        FROM documents"""
WORDS = """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(line, ' ')) AS word
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY word"""

ORACLES: dict[str, str] = {
    "json_titled_strict": TITLED,
    "json_optional_columns": f"""SELECT 'top_authors' AS report, least(10, count(DISTINCT source)) AS report_rows FROM documents
        UNION ALL SELECT 'top_scores_by_author', least(20, count(DISTINCT source)) FROM documents
        UNION ALL SELECT 'keyword_counts', {len(KEYWORDS)} FROM (SELECT count(*) FROM documents)""",
    "sentiment_repeated_ids": f"""WITH {PLAIN.replace(POSTS, TURNS)} SELECT author AS id, subreddit AS turn, sentiment_compound, sentiment_pos,
        {labeled_as('sentiment_compound')} AS sentiment_label FROM plain""",
    "sentiment_large_lexicon": f"WITH {PLAIN} SELECT id, sentiment_compound, sentiment_pos, sentiment_neu, sentiment_neg FROM plain",
    "emotion_repeated_ids": f"""WITH {TURNS}, {TURN_EMOTIONS} SELECT author AS id, subreddit AS turn, top_emotion, emotion_scores
        FROM emotions JOIN posts USING (id)""",
    "hydrate_append_repeated": f"WITH {LAST_TURNS} SELECT id, text FROM last_turns WHERE id IN (SELECT doc_id::VARCHAR FROM labels) AND text <> ''",
    "first_rows": "SELECT doc_id::VARCHAR AS id FROM labels ORDER BY doc_id::VARCHAR LIMIT 100",
    "ml_hashed_features": f"""WITH {POSTS} SELECT count(*) AS post_count,
        sum(len(regexp_split_to_array(regexp_replace(lower(text), '\\s+$', ''), '\\s')))::BIGINT AS word_count FROM posts""",
    "ml_predictions": f"WITH {LABELED} SELECT id, weak_label, {SPLIT} AS split, true AS is_known FROM labeled",
    "ml_ngram_model": f"""WITH {LABELED} SELECT id, weak_label, CASE WHEN row_number() OVER (PARTITION BY weak_label
        ORDER BY md5('42:' || id), id) <= floor(count(*) OVER (PARTITION BY weak_label) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split,
        true AS is_known FROM labeled""",
    "ml_distribution": "SELECT count(*) AS post_count, 0::BIGINT AS unknown_labels FROM documents",
    "ml_confusion": f"WITH {LABELED} SELECT weak_label, count(*) AS count FROM labeled GROUP BY weak_label",
    "ml_metrics": f"""WITH {LABELED}, sides AS (SELECT {SPLIT} AS split FROM labeled WHERE weak_label <> 'other' AND text <> '')
        SELECT count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows, true AS same_f1,
        true AS same_accuracy FROM sides""",
    "ml_model_roundtrip": "SELECT count(*) AS post_count, 0::BIGINT AS differing FROM documents",
    "word_count_text": f"SELECT '(' || word || ',' || n || ')' AS value, count(*) AS count FROM ({WORDS}) GROUP BY 1",
    "stream_copies": """SELECT copy, event_id FROM events, (VALUES ('quoted'), ('lines')) c(copy) WHERE event_type = 'purchase'""",
    "stream_new_posts_timed": "SELECT DISTINCT user_id AS id FROM events",
    "view_sql": f"""WITH {STATUSES} SELECT time_zone, user_lang, count(*) AS row_count, max(followers_count) AS most_followers
        FROM english GROUP BY time_zone, user_lang""",
    "json_posts": f"""SELECT doc_id::VARCHAR AS id, source AS author, lang AS subreddit, n_chars AS score, {TRIMMED.format('text')} AS text
        FROM documents""",
    "json_posts_strict": "SELECT doc_id::VARCHAR AS id, source AS author, lang AS subreddit, n_chars AS score, text FROM documents",
    "status_json": f"WITH {STATUSES} SELECT {PROJECTED} FROM statuses",
    "text_lines": """SELECT value, count(*) AS count FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents) GROUP BY value""",
    "annotation_csv": """SELECT doc_id::VARCHAR AS id, 'q' || quality AS "Information_Integrity", toxic AS "Linguistic_Bias",
        quality AS "Casualty", (1 - quality)::INTEGER AS "Damage", NULL::INTEGER AS "Advice" FROM labels""",
    "report_csv": f"WITH {POSTS} SELECT author, subreddit, count(*) AS count FROM posts GROUP BY author, subreddit",
    "pair_text": f"""WITH {STATUSES} SELECT '(' || screen_name || ',' || coalesce(location, 'null') || ')' AS value, count(*) AS count
        FROM english GROUP BY 1""",
    "hashtag_lists": f"""WITH {STATUSES} SELECT '["' || array_to_string(hashtags, '","') || '"]' AS value, count(*) AS count
        FROM statuses GROUP BY 1""",
    "first_field_table": "SELECT split_part(text, ',', 1) AS first_field FROM documents",
    "post_text": f"SELECT doc_id::VARCHAR AS id, {TRIMMED.format('text')} AS text FROM documents",
    "normalize_text": f"SELECT doc_id AS id, {NORMALIZED} AS normalized FROM documents",
    "nested_project": f"WITH {STATUSES} SELECT {PROJECTED} FROM statuses",
    "lang_filter": f"WITH {STATUSES} SELECT id, lang, own_text AS text FROM english",
    "user_locations": f"WITH {STATUSES} SELECT screen_name, location FROM english WHERE location IS NOT NULL",
    "entity_arrays": f"""SELECT doc_id AS id, len({DOC_TAGS}) AS hashtag_count, array_to_string(list_sort({DOC_TAGS}), ',') AS hashtags,
        array_to_string(list_sort({DOC_NAMES}), ',') AS mentions, array_to_string(list_sort({DOC_URLS}), ',') AS urls FROM documents""",
    "hashtag_rows": f"SELECT doc_id AS id, unnest({DOC_TAGS}) AS hashtag FROM documents",
    "reshare_text": """SELECT c.conv_id, c.turn, CASE WHEN c.turn % 2 = 1 AND p.text IS NOT NULL THEN p.text ELSE c.text END AS shown_text
        FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1""",
    "status_flatten": f"""WITH {STATUSES} SELECT id, strftime(o_orderdate, '%a %b %d %H:%M:%S') || ' +0000 ' || strftime(o_orderdate, '%Y') AS created_at,
        floor(epoch(o_orderdate))::BIGINT AS created_epoch, coalesce(shared_text, own_text) AS text,
        array_to_string(list_sort(hashtags), ',') AS hashtags, n_name AS mentions, 'http://' || n_name AS urls, media_urls,
        followers_count, friends_count FROM english""",
    "bad_record_filter": f"""WITH lines AS (SELECT event_id, {LINES} AS value FROM events)
        SELECT event_id, (value->>'k')::BIGINT AS k FROM lines WHERE json_valid(value)""",
    "bad_record_counts": f"""WITH lines AS (SELECT event_type, {LINES} AS value FROM events)
        SELECT event_type, count(*) FILTER (NOT json_valid(value)) AS dropped, count(*) FILTER (json_valid(value)) AS kept
        FROM lines GROUP BY event_type""",
    "created_epoch": "SELECT event_id, floor(epoch(ts))::BIGINT AS created_epoch FROM events",
    "flag_labels": """SELECT doc_id, concat_ws(',', CASE WHEN quality = 1 THEN 'quality' END, CASE WHEN toxic = 1 THEN 'toxic' END) AS names
        FROM labels""",
    "trainable_rows": f"WITH {LABELED} SELECT id, weak_label FROM labeled WHERE weak_label <> 'other' AND text <> ''",
    "top_authors": f"WITH {POSTS} {grouped('author', 'posts', 10)}",
    "community_counts": f"WITH {POSTS} {grouped('subreddit', 'posts', 15)}",
    "top_scores_by_author": f"""WITH {POSTS} SELECT author, max(score) AS max_score, count(*) AS post_count FROM posts GROUP BY author
        ORDER BY max_score DESC, author LIMIT 20""",
    "keyword_counts": counted(KEYWORDS, "documents", "lower(text)"),
    "keyword_counts_cs": counted(RAW_TERMS, "documents", "text"),
    "device_counts": counted(DEVICES, "events", RECORD),
    "post_type_counts": """SELECT toxic = 1 AS is_self, count(*) AS count FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""",
    "post_count": "SELECT count(*) AS post_count FROM documents",
    "word_count": """SELECT word, count(*) AS count FROM (SELECT unnest(string_split(line, ' ')) AS word
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY word""",
    "hashtag_counts": f"SELECT hashtag, count(*) AS count FROM (SELECT unnest({DOC_TAGS}) AS hashtag FROM documents) GROUP BY hashtag",
    "status_user_counts": f"WITH {STATUSES} {grouped('screen_name', 'english', 10, 'row_count')}",
    "status_followers": f"WITH {STATUSES} {grouped('followers_count, screen_name', 'english', 50, 'row_count')}",
    "status_friends": f"WITH {STATUSES} {grouped('friends_count, screen_name', 'english', 50, 'row_count')}",
    "status_statuses": f"WITH {STATUSES} {grouped('statuses_count, screen_name', 'english', 10, 'row_count')}",
    "status_top_followers": f"""WITH {STATUSES} SELECT screen_name, max(followers_count) AS followers_count FROM english
        GROUP BY screen_name ORDER BY followers_count DESC, screen_name LIMIT 50""",
    "status_languages": f"WITH {STATUSES} {grouped('user_lang', 'statuses', 15, 'row_count')}",
    "popular_users": f"""WITH {STATUSES}, nt AS ({grouped('screen_name', 'english', 10, 'row_count')}),
        fc AS ({grouped('followers_count, screen_name', 'english', 50, 'row_count')})
        SELECT DISTINCT nt.screen_name, fc.followers_count FROM nt JOIN fc ON nt.screen_name = fc.screen_name""",
    "user_timezones": f"WITH {STATUSES} SELECT screen_name, time_zone FROM english",
    "keyword_counts_many": f"""SELECT keyword, count(doc_id) AS count FROM (VALUES {MANY}) k(keyword)
        LEFT JOIN documents ON contains(lower(text), keyword) GROUP BY keyword""",
    "weak_labels_once": f"WITH {LABELED} SELECT id, weak_label FROM labeled",
    "symbol_texts": f"WITH {SPELLED_POSTS} SELECT id, text FROM posts",
    "sentiment_symbols": f"""WITH {ruled(SPELLED_POSTS)} SELECT id, sentiment_compound, sentiment_pos, sentiment_neu, sentiment_neg,
        {labeled_as('sentiment_compound')} AS sentiment_label FROM ruled""",
    "record_fields": f"""WITH shapes(path, kind, event_type) AS (VALUES {', '.join(f"({quote(p)}, {quote(k)}, {quote(e)})" for p, k, e in SHAPES)}),
        good AS (SELECT * FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup'))
        SELECT path, kind, count(*) AS count FROM shapes JOIN good USING (event_type) GROUP BY ALL
        UNION ALL SELECT path, kind, count(*) FROM good, (VALUES ('$', 'OBJECT'), ('$.props', 'OBJECT'), ('$.props.k', 'BIGINT')) p(path, kind) GROUP BY ALL
        UNION ALL SELECT '$', 'MALFORMED', count(*) FROM events WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup') HAVING count(*) > 0""",
    "record_typed": """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN user_id END AS "user",
        event_type IN ('purchase', 'signup') AS is_unfit FROM events""",
    "hydrate_append_bucketed": """SELECT doc_id::VARCHAR AS id, 'q' || quality AS information_integrity, quality = 1 AS "Casualty"
        FROM labels JOIN documents USING (doc_id) WHERE trim(text) <> ''""",
    "stream_growing": "SELECT event_id, event_type FROM events WHERE event_type = 'signup'",
    "weak_labels": f"WITH {LABELED} SELECT id, weak_label FROM labeled",
    "weak_label_distribution": f"WITH {LABELED} SELECT weak_label, count(*) AS count FROM labeled GROUP BY weak_label",
    "masked_labels": f"""WITH masked AS (SELECT trim(regexp_replace(regexp_replace(lower(text), '{'|'.join(MASKED)}', '*', 'g'), '\\s+', ' ', 'g')) AS normalized
        FROM documents) SELECT {rule_case()} AS weak_label, count(*) AS count FROM masked GROUP BY 1""",
    "sentiment_scores": f"WITH {PLAIN} SELECT id, sentiment_compound, sentiment_pos, sentiment_neu, sentiment_neg FROM plain",
    "sentiment_labels": f"WITH {PLAIN} SELECT id, {labeled_as('sentiment_compound')} AS sentiment_label FROM plain",
    "sentiment_rules": f"""WITH {RULED} SELECT id, sentiment_compound, sentiment_pos, sentiment_neu, sentiment_neg,
        {labeled_as('sentiment_compound')} AS sentiment_label FROM ruled""",
    "sentiment_distribution": f"WITH {RULED} SELECT {labeled_as('sentiment_compound')} AS sentiment_label, count(*) AS count FROM ruled GROUP BY 1",
    "most_positive": f"""WITH {PLAIN} SELECT id, author, subreddit, {labeled_as('sentiment_compound')} AS sentiment_label, sentiment_compound
        FROM plain ORDER BY sentiment_compound DESC, id LIMIT 50""",
    "most_negative": f"""WITH {PLAIN} SELECT id, author, subreddit, {labeled_as('sentiment_compound')} AS sentiment_label, sentiment_compound
        FROM plain ORDER BY sentiment_compound, id LIMIT 50""",
    "affect_tokens": """SELECT id, token, count(*) AS count FROM (SELECT doc_id AS id,
        unnest(regexp_extract_all(lower(text), '[A-Za-z'']+')) AS token FROM documents) GROUP BY id, token""",
    "emotion_scores": f"WITH {emotions()} SELECT id, affect, n FROM affect_rows",
    "top_emotion": f"WITH {emotions()} SELECT id, top_emotion FROM emotions",
    "top_emotion_listed": f"WITH {emotions('listed')} SELECT id, top_emotion FROM emotions",
    "emotion_json": f"WITH {emotions()} SELECT id, emotion_scores FROM emotions",
    "emotion_distribution": f"WITH {emotions()} SELECT top_emotion, count(*) AS count FROM emotions GROUP BY top_emotion",
    "enriched_posts": f"""WITH {RULED}, {emotions()} SELECT id, author, subreddit, score, text, sentiment_compound, sentiment_pos,
        sentiment_neu, sentiment_neg, {labeled_as('sentiment_compound')} AS sentiment_label, top_emotion, emotion_scores,
        {rule_case(NORMALIZED)} AS weak_label FROM ruled JOIN emotions USING (id)""",
    "label_sentiment_summary": f"""WITH {RULED} SELECT {rule_case(NORMALIZED)} AS weak_label,
        {labeled_as('sentiment_compound')} AS sentiment_label, count(*) AS count FROM ruled GROUP BY 1, 2""",
    "hydrate_join": f"""WITH {ANNOTATIONS}, {SUBMISSIONS} SELECT id, 'forum' AS source, 'forum' AS platform, 'labels' AS dataset,
        subreddit, coalesce(author, '[deleted]') AS author, title, selftext,
        {TRIMMED.format("CASE WHEN selftext = '' THEN title ELSE title || chr(10) || selftext END")} AS text,
        coalesce(score, 0) AS score, 0::BIGINT AS num_comments, 0::BIGINT AS created_utc,
        CASE WHEN permalink <> '' THEN permalink ELSE full_link END AS permalink, coalesce(is_self, true) AS is_self,
        concat_ws(',', CASE WHEN casualty THEN 'Casualty' END, CASE WHEN damage THEN 'Damage' END,
          CASE WHEN recovery THEN 'Recovery' END) AS humanitarian_labels,
        information_integrity, linguistic_bias, false AS political_bias, false AS gender_bias, false AS hate_speech,
        false AS racial_bias, casualty AS "Casualty", false AS "Evacuation", damage AS "Damage", false AS "Advice",
        false AS "Request", false AS "Assistance", recovery AS "Recovery"
        FROM annotations JOIN submissions USING (id)
        WHERE {TRIMMED.format("title || chr(10) || selftext")} <> ''""",
    "hydrate_missing": "SELECT doc_id::VARCHAR AS id FROM labels WHERE doc_id NOT IN (SELECT conv_id FROM conversations)",
    "hydrate_last": f"WITH {LAST_TURNS} SELECT id, text FROM last_turns",
    "hydrate_resume": "SELECT doc_id::VARCHAR AS id FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages)",
    "hydrate_stats": f"""WITH {LAST_TURNS}, tried AS (SELECT doc_id::VARCHAR AS id FROM labels
          WHERE doc_id NOT IN (SELECT page_id FROM pages)),
        good AS (SELECT id FROM tried JOIN last_turns USING (id) WHERE text <> '')
        SELECT (SELECT count(*) FROM labels) AS annotation_rows,
          (SELECT count(*) FROM pages) + (SELECT count(*) FROM good) AS hydrated_posts,
          (SELECT count(*) FROM tried) - (SELECT count(*) FROM good) AS missing_or_empty""",
    "hydrate_append": """SELECT doc_id::VARCHAR AS id, 'q' || quality AS information_integrity, quality = 1 AS "Casualty"
        FROM labels JOIN documents USING (doc_id) WHERE trim(text) <> ''""",
    "label_index": f"""WITH {LABELED} SELECT weak_label, row_number() OVER (ORDER BY count(*) DESC, weak_label) - 1 AS label_index,
        count(*) AS count FROM labeled WHERE weak_label <> 'other' GROUP BY weak_label""",
    "post_reports": f"""WITH {LABELED}, typed AS (SELECT labeled.*, toxic = 1 AS is_self,
          CASE WHEN length(text) % 7 - 3 >= 0.05 THEN 'positive' WHEN length(text) % 7 - 3 <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment_label
          FROM labeled LEFT JOIN labels ON doc_id = id),
        listed AS (
          SELECT 'top_authors' AS report, author AS keys, score FROM typed
          UNION ALL SELECT 'community_counts', subreddit, score FROM typed
          UNION ALL SELECT 'post_type_counts', is_self::VARCHAR, score FROM typed
          UNION ALL SELECT 'sentiment_distribution', sentiment_label, score FROM typed
          UNION ALL SELECT 'ml_distribution', subreddit, score FROM typed
          UNION ALL SELECT 'ml_confusion_summary', weak_label || '|' || coalesce(subreddit, '-'), score FROM typed)
        SELECT report, coalesce(keys, '-') AS keys, count(*) AS count, max(score) AS max_score FROM listed GROUP BY ALL""",
    "sql_functions": f"""WITH {LABELED} SELECT id, weak_label, CASE WHEN score / 5000.0 - 1 >= 0.05 THEN 'positive'
          WHEN score / 5000.0 - 1 <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
          length(normalized)::INTEGER AS normalized_length, coalesce(toxic = 1, false) AS is_self FROM labeled LEFT JOIN labels ON doc_id = id""",
    "ml_single_words": f"""WITH {POSTS}, words AS (SELECT id, id % 10 AS word, {SPLIT} AS split,
          CASE WHEN (id % 10 < 5) <> (id // 10 % 10 = 3) THEN 'low' ELSE 'high' END AS weak_label FROM posts),
        best AS (SELECT word, CASE WHEN 2 * count(*) FILTER (weak_label = 'low') > count(*) THEN 'low' ELSE 'high' END AS ml_predicted_label
          FROM words WHERE split = 'train' GROUP BY word)
        SELECT id, weak_label, split, ml_predicted_label FROM words JOIN best USING (word)""",
    "split_hash": f"WITH {POSTS} SELECT id, {SPLIT} AS split FROM posts",
    "split_stratified": f"""WITH {LABELED} SELECT id, weak_label, CASE WHEN row_number() OVER (PARTITION BY weak_label
        ORDER BY md5('42:' || id), id) <= floor(count(*) OVER (PARTITION BY weak_label) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split
        FROM labeled""",
    "tfidf_terms": f"""WITH {POSTS}, words AS (SELECT id, unnest(regexp_split_to_array(regexp_replace(lower(text), '\\s+$', ''), '\\s')) AS term FROM posts),
        tfs AS (SELECT id, term, count(*) AS tf FROM words GROUP BY id, term),
        dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term)
        SELECT id, term, tf, df, round(tf * ln(((SELECT count(*) FROM posts) + 1) / (df + 1)), 6) AS tfidf FROM tfs JOIN dfs USING (term)""",
    "ngram_vocab": """WITH lists AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS ts FROM documents),
        rows AS (SELECT doc_id, unnest(ts) AS word, generate_subscripts(ts, 1) AS i FROM lists),
        pairs AS (SELECT word, lead(word) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM rows),
        grams AS (SELECT word AS term FROM pairs UNION ALL SELECT word || ' ' || after FROM pairs WHERE after IS NOT NULL)
        SELECT term, count(*) AS count FROM grams GROUP BY term ORDER BY count DESC, term LIMIT 4096""",
    "confusion_summary": f"WITH {GUESSED} SELECT label, prediction, count(*) AS count FROM guessed GROUP BY label, prediction",
    "classification_metrics": f"""WITH {GUESSED}, truth AS (SELECT label AS class, count(*) AS support FROM guessed GROUP BY label),
        said AS (SELECT prediction AS class, count(*) AS guessed FROM guessed GROUP BY prediction),
        good AS (SELECT label AS class, count(*) AS hits FROM guessed WHERE label = prediction GROUP BY label),
        per AS (SELECT support, coalesce(hits, 0) AS hits, 2.0::DOUBLE * coalesce(hits, 0) / (support + coalesce(guessed, 0)) AS f1
          FROM truth LEFT JOIN said USING (class) LEFT JOIN good USING (class))
        SELECT round(sum(f1 * support) / sum(support), 4) AS f1, round(sum(hits) / sum(support), 4) AS accuracy,
          sum(support)::BIGINT AS rows FROM per""",
    "stream_track": """SELECT event_id, event_type, user_id FROM events WHERE contains(event_type, 'error') OR contains(event_type, 'signup')""",
    "stream_new_posts": "SELECT DISTINCT conv_id AS id FROM conversations",
}
ORACLES["metrics_json"] = ORACLES["classification_metrics"]

ORACLES["ngram_vocab_bounded"] = ORACLES["ngram_vocab"]
