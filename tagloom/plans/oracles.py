"""Comparison SQL (DuckDB dialect) for the registered queries, written from the operator
definitions: windows, joins and list functions instead of the library's expressions."""

from __future__ import annotations

from tagloom.functions.codelang import RULES, TEXT_ONLY, THRESHOLD, languages
from tagloom.functions.lemma import LEXICON, NOUN, SUFFIX_RULES, VERB
from tagloom.functions.text import (
    BODY_EXTRA_STOP_WORDS,
    COMMON_SIGNS,
    SIGN_EXCEPTIONS,
    TAG_PATTERN,
)
from tagloom.plans import registry as R

SPACE = "\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
SIGNS = "[" + " | ".join(COMMON_SIGNS) + "]"
SEPARATORS = "[" + SPACE + " | ".join(COMMON_SIGNS) + "]+"


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words_in(values) -> str:
    return ", ".join(q(v) for v in values)


STOPS = words_in(R.STOP_WORDS)

POSTS = f"""
posts AS (
  SELECT d.doc_id AS Id, substr(string_split(d.text, chr(10))[1], 1, 200) AS Title, d.text AS Body,
    '<' || lang || '><' || source || '><q-' || coalesce(quality::VARCHAR, 'na') || '><t-'
      || coalesce(toxic::VARCHAR, 'na') || '><len-' || length(n_chars::VARCHAR) || '>' AS Tags,
    len(string_split(d.text, ' ')) AS Score, n_chars AS ViewCount, n_chars // 10 AS FavoriteCount,
    len(string_split(d.text, chr(10))) AS AnswerCount,
    CASE WHEN d.doc_id % 5 = 0 THEN 2 ELSE 1 END AS PostTypeId
  FROM documents d LEFT JOIN labels l USING (doc_id)
)"""

TAGGED = f"""{POSTS}, tagged AS (
  SELECT Id, list_transform(regexp_extract_all(Tags, {q(TAG_PATTERN)}, 1), lambda t: lower(t)) AS ntags FROM posts
), tags AS (SELECT Id, unnest(ntags) AS tag FROM tagged)"""


def body_words(expr: str) -> str:
    return (
        f"list_filter(string_split_regex(regexp_replace(lower({expr}), '[0-9]+', '', 'g'), {q(SEPARATORS)}), "
        f"lambda w: w <> '' AND w NOT IN ({STOPS}))"
    )


def title_words(expr: str) -> str:
    pieces = f"string_split_regex(regexp_replace(lower({expr}), '[0-9]+', '', 'g'), {q('[' + SPACE + ']+')})"
    parts = (
        f"flatten(list_transform({pieces}, lambda p: CASE WHEN p IN ({words_in(SIGN_EXCEPTIONS)}) THEN [p] "
        f"ELSE string_split_regex(p, {q(SIGNS)}) END))"
    )
    return f"list_filter({parts}, lambda w: w <> '' AND w NOT IN ({STOPS}))"


WORDS = f"""{POSTS}, words AS (SELECT Id, {body_words('Body')} AS tokens FROM posts),
occ AS (SELECT Id, unnest(tokens) AS token FROM words),
n_docs AS (SELECT count(*) AS n FROM words),
tc AS (SELECT token, count(*) AS term_count, count(DISTINCT Id) AS doc_count FROM occ GROUP BY token),
tf AS (SELECT token, term_count, doc_count, term_count / sum(term_count) OVER () AS term_freq,
         doc_count / (SELECT n FROM n_docs) AS doc_freq FROM tc)"""


def lemma_case(allowed) -> str:
    case = "CASE"
    for token, pos, lemma in LEXICON:
        case += f" WHEN w = {q(token)} THEN {q(lemma if pos in allowed else '')}"
    for ending, shortest, pos, cut, added in SUFFIX_RULES:
        if pos not in allowed:
            value = "''"
        else:
            value = f"substr(w, 1, length(w) - {cut}) || {q(added)}"
        case += f" WHEN ends_with(w, {q(ending)}) AND length(w) >= {shortest} THEN {value}"
    return case + (" ELSE w END" if NOUN in allowed else " ELSE '' END")


# The lemma of every distinct word once; then the lists are put together by position.
def lemma_lists(source: str, allowed) -> str:
    return f"""{source}, vocab AS (SELECT DISTINCT token AS w FROM pairs),
lemmas AS (SELECT w, {lemma_case(allowed)} AS lemma FROM vocab)"""


PAIRS = "pairs AS (SELECT Id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM words)"


def lemmatized(source: str, allowed, drop_empty: bool, extra=()) -> str:
    condition = " AND ".join(
        (["lemma <> ''"] if drop_empty else []) + ([f"lemma NOT IN ({words_in(extra)})"] if extra else [])
    )
    where = f"FILTER (WHERE {condition})" if condition else ""
    return f"""WITH {lemma_lists(source + ', ' + PAIRS, allowed)}
SELECT words.Id, coalesce(string_agg(lemma, '|' ORDER BY pos) {where}, '') AS tokens
FROM words LEFT JOIN pairs ON words.Id = pairs.Id LEFT JOIN lemmas ON pairs.token = lemmas.w GROUP BY words.Id"""


BODY = f"{POSTS}, words AS (SELECT Id, {body_words('Body')} AS tokens FROM posts)"
TITLE = f"{POSTS}, words AS (SELECT Id, {title_words('Title')} AS tokens FROM posts)"

# HTML: one row per piece, the last opened tag carried forward by a window.
HTML_PIECES = (
    "(?is)<!--.*?-->|<script(?:[\\s/][^>]*)?>.*?</script\\s*>|<style(?:[\\s/][^>]*)?>.*?</style\\s*>"
    "|<[!?][^>]*>|</?[a-z][^>]*>|<|[^<]+"
)


def unescaped(expr: str) -> str:
    known = {"&copy;": "©", "&middot;": "·", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&amp;": "&"}
    for entity, char in known.items():
        expr = f"replace({expr}, {q(entity)}, {q(char)})"
    # At the end of a cut-off page the semicolon can be missing.
    return f"regexp_replace({expr}, '&amp$', '&')"


SEGMENTS = f"""
pieces AS (
  SELECT page_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k
  FROM (SELECT page_id, regexp_extract_all(html, {q(HTML_PIECES)}) AS p FROM pages)
), kinds AS (
  SELECT page_id, k, piece,
    regexp_matches(piece, '(?is)^<(script|style)\\b.*</(script|style)\\s*>$') AS is_raw,
    lower(regexp_extract(piece, '^<([a-zA-Z][^\\s/>]*)', 1)) AS name
  FROM pieces
), attributed AS (
  SELECT page_id, k, piece, is_raw,
    coalesce(last_value(CASE WHEN name NOT IN ('', 'br', 'img', 'hr') THEN name END IGNORE NULLS)
      OVER (PARTITION BY page_id ORDER BY k), 'NO_TAG') AS tag
  FROM kinds
), nodes AS (
  SELECT page_id, k, tag, trim(CASE
      WHEN is_raw THEN regexp_extract(piece, '(?is)^<[^>]*>(.*)</[a-z]+\\s*>$', 1)
      WHEN piece = '<' OR NOT starts_with(piece, '<') THEN {unescaped('piece')}
      ELSE '' END, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160)) AS text
  FROM attributed
), segments AS (
  SELECT page_id AS Id, k, tag, text, row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS pos
  FROM nodes WHERE text <> ''
), tag_order AS (
  SELECT *, min(pos) OVER (PARTITION BY Id, tag) AS first_pos FROM segments
), every AS (SELECT page_id AS Id FROM pages)"""


def by_tag(condition: str) -> str:
    return f"coalesce(string_agg(text, '|' ORDER BY first_pos, pos) FILTER (WHERE {condition}), '')"


def language_case(expr: str) -> str:
    scores = []
    for k, language in enumerate(languages()):
        total = " + ".join(
            f"CASE WHEN regexp_matches({expr}, {q(pattern)}) THEN {weight} ELSE 0 END"
            for name, pattern, weight in RULES
            if name == language
        )
        scores.append(f"{{'score': {total}, 'rank': {-k}, 'language': {q(language)}}}")
    return f"list_max([{', '.join(scores)}])"


CODE = f"""{SEGMENTS}, guesses AS (
  SELECT Id, row_number() OVER (PARTITION BY Id ORDER BY first_pos, pos) - 1 AS pos, text AS code,
    {language_case('text')} AS best
  FROM tag_order WHERE tag IN ('code', 'script', 'style')
), code AS (
  SELECT Id, pos, code, CASE WHEN best.score >= {THRESHOLD} THEN best.language END AS language FROM guesses
)"""

RANKED = f"""{WORDS}, ranked AS (
  SELECT token, term_count, doc_count,
    row_number() OVER (ORDER BY term_count DESC, token) AS term_rank,
    row_number() OVER (ORDER BY doc_count DESC, token) AS doc_rank,
    sum(term_count) OVER (ORDER BY term_count DESC, token ROWS UNBOUNDED PRECEDING) AS term_sum,
    sum(doc_count) OVER (ORDER BY doc_count DESC, token ROWS UNBOUNDED PRECEDING) AS doc_sum,
    sum(term_count) OVER () AS term_total, sum(doc_count) OVER () AS doc_total
  FROM tc
)"""


def kept_by_doc_freq(low: float, high: float) -> str:
    return f"""WITH {WORDS}, vocab AS (
  SELECT token FROM tf WHERE doc_freq > CAST('{low}' AS DOUBLE) AND doc_freq < CAST('{high}' AS DOUBLE)
), p AS (SELECT Id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM words)
SELECT words.Id, coalesce(string_agg(vocab.token, '|' ORDER BY pos), '') AS tokens
FROM words LEFT JOIN p ON words.Id = p.Id LEFT JOIN vocab ON vocab.token = p.token GROUP BY words.Id"""


SEQUENCES = f"""{RANKED}, ids AS (
  SELECT token, term_rank + 1 AS word_id FROM ranked WHERE term_rank <= {R.VOCAB - 2}
), heads AS (
  SELECT Id, unnest(list_slice(tokens, 1, {R.SEQ_LEN})) AS token,
    generate_subscripts(list_slice(tokens, 1, {R.SEQ_LEN}), 1) - 1 AS pos FROM words
), coded AS (
  SELECT heads.Id, heads.pos, coalesce(ids.word_id, 1) AS word_id FROM heads LEFT JOIN ids USING (token)
)"""

SKIPGRAMS = f"""{RANKED}, ids AS (
  SELECT token, term_rank + 1 AS word_id FROM ranked WHERE term_rank <= {R.VOCAB - 2}
), whole AS (SELECT Id, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos FROM words),
coded AS (SELECT whole.Id, whole.pos, coalesce(ids.word_id, 1) AS word_id FROM whole LEFT JOIN ids USING (token)),
near AS (
  SELECT Id, pos, word_id AS target, {", ".join(f"lead(word_id, {k}) OVER w AS after_{k}, lag(word_id, {k}) OVER w AS before_{k}" for k in range(1, R.WINDOW + 1))}
  FROM coded WINDOW w AS (PARTITION BY Id ORDER BY pos)
), grams AS (
  {" UNION ALL ".join(f"SELECT Id, pos, pos {sign} {k} AS context_pos, target, {name}_{k} AS context FROM near WHERE {name}_{k} IS NOT NULL"
                      for k in range(1, R.WINDOW + 1) for sign, name in (("+", "after"), ("-", "before")))}
)"""


def uniform(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def split(source: str, key: str) -> str:
    return f"""{source}, keyed AS (
  SELECT Id, {key} AS k, md5('42|' || Id::VARCHAR) AS h FROM rows_
), counted AS (
  SELECT Id, h, CASE WHEN count(*) OVER (PARTITION BY k) > 1 THEN 'key ' || k ELSE 'rest' END AS stratum FROM keyed
), ranked_rows AS (
  SELECT Id, row_number() OVER (PARTITION BY stratum ORDER BY h, Id) AS r, count(*) OVER (PARTITION BY stratum) AS n
  FROM counted
), parts AS (SELECT Id, r <= floor(n * 0.2::DOUBLE + 0.5) AS is_test FROM ranked_rows)"""


def label_filter(n: int, name: str = "rows_") -> str:
    return f"""{TAGGED}, top_tags AS (
  SELECT tag FROM tags GROUP BY tag ORDER BY count(DISTINCT Id) DESC, tag LIMIT {n}
), {name} AS (
  SELECT Id, ntags, list_filter(ntags, lambda t: list_contains((SELECT list(tag) FROM top_tags), t)) AS kept FROM tagged
)"""


LABEL_ROWS = f"""{TAGGED}, places AS (
  SELECT Id, unnest(ntags) AS tag, generate_subscripts(ntags, 1) AS pos FROM tagged
)"""


def kept_labels(n: int) -> str:
    return f"""{LABEL_ROWS}, top_tags AS (
  SELECT tag FROM tags GROUP BY tag ORDER BY count(DISTINCT Id) DESC, tag LIMIT {n}
), rows_ AS (
  SELECT tagged.Id, any_value(ntags) AS ntags,
    coalesce(string_agg(t.tag, '|' ORDER BY p.pos), '') AS kept,
    coalesce(string_agg(t.tag, '_' ORDER BY t.tag), '') AS kept_key,
    count(t.tag) AS n_kept
  FROM tagged LEFT JOIN places p ON p.Id = tagged.Id LEFT JOIN top_tags t ON t.tag = p.tag GROUP BY tagged.Id
)"""


def test_rows(n: int, extra: str, vectors: bool = False, strata: int | None = None) -> str:
    """The test part of a run over the ``n`` most used labels; ``vectors``: only rows that have one; ``strata``: split by so many labels."""
    vecs = "JOIN embeddings ON vec_id = rows_.Id" if vectors else ""
    source, key = kept_labels(n), "kept_key"
    if strata is not None:
        source += f""", common AS (
  SELECT list(tag) AS tags FROM (SELECT tag FROM tags GROUP BY tag ORDER BY count(DISTINCT Id) DESC, tag LIMIT {strata})
)"""
        key = "array_to_string(list_sort(list_intersect(string_split(kept_key, '_'), (SELECT tags FROM common))), '_')"
    return f"""WITH {split(source, key)}
SELECT rows_.Id, kept AS truth, {extra} FROM rows_ JOIN parts ON parts.Id = rows_.Id {vecs} WHERE is_test"""


THETA = """
dims AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
theta AS (
  SELECT vec_id, dim AS topic, abs(v) / sum(abs(v)) OVER (PARTITION BY vec_id) AS share FROM dims WHERE dim < 10
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY share DESC, topic) AS r FROM theta
)"""

PHI = """
means AS (SELECT label AS topic, dim, avg(abs(v)) AS m FROM dims GROUP BY label, dim),
phi AS (SELECT topic, dim, 'w' || dim AS term, m / sum(m) OVER (PARTITION BY topic) AS p FROM means)"""

TERM_SCORES = f"""{THETA}, {PHI}, scores AS (
  SELECT vec_id, term, dim, sum(share * p) AS prob
  FROM ordered JOIN phi USING (topic) WHERE r <= {R.N_TOPIC} GROUP BY vec_id, term, dim
)"""

KNOWN_TAGS = f"""{POSTS}, title_lists AS (SELECT Id, {title_words('Title')} AS tokens FROM posts),
title_occ AS (SELECT DISTINCT Id, unnest(tokens) AS token FROM title_lists),
known AS (SELECT token FROM title_occ GROUP BY token)"""

SUGGESTED = f"""WITH {KNOWN_TAGS},
body_lists AS (SELECT Id, {body_words('Body')} AS tokens FROM posts),
word_rows AS (
  SELECT Id, unnest(tokens) AS w, 'title' AS part FROM title_lists
  UNION ALL SELECT Id, unnest(tokens), 'body' FROM body_lists
), vocab AS (SELECT DISTINCT w FROM word_rows),
lemmas AS (SELECT w, {lemma_case((VERB, NOUN))} AS any_lemma, {lemma_case((NOUN,))} AS noun_lemma FROM vocab),
found AS (
  SELECT DISTINCT Id, CASE WHEN part = 'title' THEN any_lemma ELSE noun_lemma END AS tag, part
  FROM word_rows JOIN lemmas USING (w)
  WHERE NOT (part = 'body' AND noun_lemma IN ({words_in(BODY_EXTRA_STOP_WORDS)}))
), hits AS (SELECT DISTINCT Id, tag FROM found JOIN known ON known.token = found.tag)
SELECT posts.Id, coalesce(string_agg(tag, '|' ORDER BY tag), '') AS tags
FROM posts LEFT JOIN hits ON hits.Id = posts.Id GROUP BY posts.Id"""


def pieces(column: str, separator: str = "' '") -> str:
    return f"string_split({column}, {separator})"


def coverage_sizes(stat: str) -> str:
    shares = ", ".join(f"({k}, {k * 1000})" for k in range(1, 10))
    return f"""sizes AS (
  SELECT s.k, coalesce(min(CASE WHEN {stat}_sum * 10000 >= s.parts * {stat}_total THEN {stat}_rank END), count(*)) AS size
  FROM ranked, (VALUES {shares}) s(k, parts) GROUP BY s.k
  UNION ALL SELECT * FROM (VALUES (10, 100), (11, 500), (12, 1000)) g(k, size)
)"""


def describe(columns) -> str:
    parts = [
        f"SELECT '{c}' AS counter, count({c}) AS count, avg({c}::DOUBLE) AS mean, stddev_samp({c}) AS std, "
        f"min({c})::DOUBLE AS min, quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50, "
        f"quantile_cont({c}::DOUBLE, 0.75) AS q75, max({c})::DOUBLE AS max FROM posts"
        for c in columns
    ]
    rounded = ", ".join(f"round({c}, 6) AS {c}" for c in ["mean", "std", "min", "q25", "q50", "q75", "max"])
    return f"WITH {POSTS} SELECT counter, count, {rounded} FROM ({' UNION ALL '.join(parts)})"


def bits_case(n_from: str) -> str:
    return f"""class_list AS (SELECT tag, row_number() OVER (ORDER BY tag) AS k, count(*) OVER () AS n FROM ({n_from})),
marked AS (
  SELECT tagged.Id, c.tag, c.k, c.n, list_contains(ntags, c.tag) AS hit FROM tagged CROSS JOIN class_list c
)"""


MIXED = f"""{CODE}, parts AS (
  SELECT s.Id, s.pos, s.text, s.tag IN ('code', 'script', 'style') AS is_code,
    CASE WHEN b.score >= {THRESHOLD} THEN b.language END AS language
  FROM (SELECT *, {language_case('text')} AS b FROM segments) s
)"""

GRID_LISTS = """(SELECT DISTINCT lang AS loss FROM documents), (SELECT DISTINCT quality::BIGINT AS vect FROM labels),
  (SELECT DISTINCT length(n_chars::VARCHAR) AS nb_tags FROM documents)"""

ORACLES: dict[str, str] = {
    "question_extract": f"""WITH {POSTS}
SELECT Title, Body, Tags, Id, Score, ViewCount, FavoriteCount, AnswerCount FROM posts
WHERE PostTypeId = 1 AND ViewCount > 10 AND FavoriteCount > 10 AND Score > 5 AND AnswerCount > 0
  AND length(Tags) - length(replace(Tags, '<', '')) >= 5 ORDER BY Id LIMIT 500000""",
    "load_questions_csv": f"""WITH {POSTS}
SELECT Title, Body, Tags, Id, Score, ViewCount, FavoriteCount, AnswerCount FROM posts""",
    "deserialize_lists": f"""WITH {POSTS}, lists AS (SELECT Id, {title_words('Title')} AS tokens FROM posts),
filled AS (SELECT Id, CASE WHEN len(tokens) = 0 THEN [''] ELSE tokens END AS tokens FROM lists)
SELECT Id, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos FROM filled""",
    "processed_csv": f"WITH {WORDS} SELECT Id, array_to_string(tokens, '|') AS tokens FROM words",
    "results_store": f"""WITH {TAGGED}
SELECT Id, upper(array_to_string(ntags, '|')) AS tags, 'second' AS run FROM tagged""",
    "embedding_store": """SELECT vec_id AS Id, generate_subscripts(embedding, 1) - 1 AS dim,
  round(unnest(embedding)::DOUBLE, 6) AS value FROM embeddings""",
    "apply_in_order": f"""WITH {POSTS}
SELECT Id, trim(regexp_replace(lower(Title), {q(SIGNS)}, ' ', 'g')) AS title FROM posts""",
    "extract_tags": f"""WITH {TAGGED}
SELECT Id, unnest(ntags) AS tag, generate_subscripts(ntags, 1) - 1 AS pos FROM tagged""",
    "lower_text": f"""WITH {POSTS}
SELECT Id, lower(Title) AS title, replace(lower(Body), ' ', '|') AS body FROM posts""",
    "remove_list": f"""WITH {POSTS}
SELECT Id, array_to_string(list_transform({pieces('Title')}, lambda w:
  CASE WHEN w IN ({words_in(R.KEPT_WORDS)}) THEN w ELSE regexp_replace(w, '[aeiou]', '_', 'g') END), '|') AS tokens FROM posts""",
    "remove_signs_list": f"""WITH {POSTS}
SELECT Id, array_to_string(list_transform({pieces('Body')}, lambda w:
  CASE WHEN w IN ({words_in(SIGN_EXCEPTIONS)}) THEN w ELSE regexp_replace(w, {q(SIGNS)}, ' ', 'g') END), '|') AS tokens FROM posts""",
    "remove_signs_str": f"""WITH {POSTS} SELECT Id, regexp_replace(Body, {q(SIGNS)}, ' ', 'g') AS body FROM posts""",
    "remove_patterns_list": f"""WITH {POSTS}
SELECT Id, replace(regexp_replace(Body, '[0-9]', '', 'g'), ' ', '|') AS tokens FROM posts""",
    "filter_list": f"""WITH {POSTS}, p AS (SELECT Id, {pieces('lower(Body)')} AS w FROM posts)
SELECT Id, array_to_string(list_filter(w, lambda x: x IN ({words_in(R.KEPT_WORDS)})), '|') AS included,
  len(list_filter(w, lambda x: x NOT IN ({words_in(R.KEPT_WORDS)}))) AS n_left FROM p""",
    "filter_empty_list": f"""WITH {POSTS}
SELECT Id, array_to_string(list_filter(string_split_regex(Body, '[., ' || chr(10) || ']'), lambda x: length(x) > 0), '|')
  AS tokens FROM posts""",
    "tokenize_list": f"""WITH {POSTS}
SELECT Id, array_to_string(list_concat(string_split_regex(Title, {q('[' + SPACE + ']+')}),
  string_split_regex(Body, {q('[' + SPACE + ']+')})), '|') AS tokens FROM posts""",
    "list_to_str": f"""WITH {TAGGED} SELECT Id, string_agg(tag, '_' ORDER BY tag) AS tags FROM tags GROUP BY Id""",
    "sort_list": f"""WITH {WORDS}
SELECT words.Id, coalesce(string_agg(token, '|' ORDER BY token), '') AS tokens
FROM words LEFT JOIN occ ON occ.Id = words.Id GROUP BY words.Id""",
    "sort_by_count": f"""WITH {LABEL_ROWS}, counts AS (
  SELECT tag, count(DISTINCT Id) AS n FROM tags GROUP BY tag HAVING count(DISTINCT Id) > 60
)
SELECT Id, string_agg(places.tag, '|' ORDER BY coalesce(n, -1), pos) AS tags
FROM places LEFT JOIN counts ON counts.tag = places.tag GROUP BY Id""",
    "merge_tokens": f"""WITH {POSTS}
SELECT Id, array_to_string(list_concat({title_words('Title')}, {body_words('Body')}), '|') AS tokens FROM posts""",
    "stop_words": f"""WITH {POSTS}
SELECT Id, array_to_string(list_filter(string_split_regex(lower(Body), {q('[' + SPACE + ']+')}),
  lambda w: w NOT IN ({STOPS})), '|') AS tokens FROM posts""",
    "lemmatize": lemmatized(BODY, (VERB, NOUN), drop_empty=False),
    "lemmatize_nouns": lemmatized(BODY, (NOUN,), drop_empty=False),
    "lemmatize_lexicon": lemmatized(BODY, (VERB, NOUN), drop_empty=False),
    "body_tokens": lemmatized(BODY, (VERB, NOUN), drop_empty=True),
    "body_tokens_wov": lemmatized(BODY, (NOUN,), drop_empty=True, extra=BODY_EXTRA_STOP_WORDS),
    "body_tokens_html": f"""WITH {lemma_lists(SEGMENTS + f''', words AS (
  SELECT Id, first_pos, pos AS node, {body_words('text')} AS tokens FROM tag_order WHERE tag NOT IN ('code', 'script', 'style')
), pairs AS (
  SELECT Id, first_pos, node, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM words
)''', (VERB, NOUN))}
SELECT every.Id, coalesce(string_agg(lemma, '|' ORDER BY first_pos, node, pos) FILTER (WHERE lemma <> ''), '') AS tokens
FROM every LEFT JOIN pairs ON pairs.Id = every.Id LEFT JOIN lemmas ON lemmas.w = pairs.token GROUP BY every.Id""",
    "title_tokens": lemmatized(TITLE, (VERB, NOUN), drop_empty=True),
    "question_text": f"""WITH {POSTS}, stripped AS (
  SELECT Id, Title, trim(Body, ' ' || chr(9) || chr(10) || chr(13)) AS body FROM posts
)
SELECT Id, Title || '. ' || body AS question,
  lower(Title || '. ' || replace(replace(body, chr(10), ' '), '"', ' ')) AS input FROM stripped""",
    "tags_bitmask": f"""WITH {TAGGED}, {bits_case(
        "SELECT tag FROM (SELECT tag, count(DISTINCT Id) AS c FROM tags GROUP BY tag ORDER BY c DESC, tag LIMIT 63)")}
SELECT Id, sum(CASE WHEN hit THEN (2 ** (n - k))::BIGINT ELSE 0 END)::BIGINT AS mask FROM marked GROUP BY Id""",
    "lookup_questions": f"""WITH {POSTS} SELECT Id, Title, Score FROM posts WHERE Id IN (0, 7, 42, 99, 150)""",
    "html_segments": f"WITH {SEGMENTS} SELECT Id, pos, tag, text FROM segments",
    "segments_by_tag": f"""WITH {SEGMENTS}
SELECT every.Id, {by_tag("tag NOT IN ('script', 'style', 'a')")} AS without,
  {by_tag("tag IN ('title', 'h1', 'li')")} AS only
FROM every LEFT JOIN tag_order t ON t.Id = every.Id GROUP BY every.Id""",
    "html_text": f"""WITH {SEGMENTS}
SELECT every.Id, coalesce(string_agg(text, '' ORDER BY pos), '') AS glued,
  coalesce(string_agg(text, ' ' ORDER BY pos), '') AS spaced
FROM every LEFT JOIN segments s ON s.Id = every.Id GROUP BY every.Id""",
    "mixed_text": f"""WITH {MIXED}
SELECT every.Id,
  coalesce(string_agg(CASE WHEN NOT is_code OR language = {q(TEXT_ONLY)} THEN ' ' || text || ' '
    WHEN language IS NULL THEN '' ELSE ' [' || language || '] ' END, '' ORDER BY pos), '') AS text,
  coalesce(string_agg(text, '|' ORDER BY pos) FILTER (WHERE is_code AND language <> {q(TEXT_ONLY)}), '') AS code
FROM every LEFT JOIN parts ON parts.Id = every.Id GROUP BY every.Id""",
    "code_language": f"WITH {CODE} SELECT Id, pos, language FROM code",
    "code_sections": f"""WITH {CODE}
SELECT every.Id, coalesce(string_agg(code, '|' ORDER BY pos) FILTER (WHERE language = {q(TEXT_ONLY)}), '') AS text,
  coalesce(string_agg(language, '|' ORDER BY pos) FILTER (WHERE language NOT IN ({q(TEXT_ONLY)}, 'CSS')), '') AS lexer
FROM every LEFT JOIN code ON code.Id = every.Id GROUP BY every.Id""",
    "term_count": f"WITH {WORDS} SELECT token AS tokens, term_count FROM tc",
    "term_freq": f"WITH {WORDS} SELECT token AS tokens, round(term_freq, 6) AS term_freq FROM tf",
    "doc_count": f"WITH {WORDS} SELECT token AS tokens, doc_count FROM tc",
    "doc_freq": f"WITH {WORDS} SELECT token AS tokens, round(doc_freq, 6) AS doc_freq FROM tf",
    "term_doc_stats": f"""WITH {WORDS}
SELECT token AS tokens, round(term_freq, 6) AS term_freq, round(doc_freq, 6) AS doc_freq FROM tf""",
    "term_doc_matrix": f"WITH {WORDS} SELECT Id, token, count(*) AS n FROM occ GROUP BY Id, token",
    "top_tokens": f"""WITH {WORDS}
SELECT token AS tokens, round(doc_freq, 6) AS doc_freq FROM tf ORDER BY doc_count DESC, token LIMIT 20""",
    "bottom_tokens": f"""WITH {WORDS}
SELECT token AS tokens, round(doc_freq, 6) AS doc_freq FROM tf ORDER BY doc_count, token LIMIT 20""",
    "tokens_usage": f"""WITH {RANKED}
SELECT 'term' AS kind, round(sum(term_count) FILTER (WHERE term_rank <= 100) / any_value(term_total), 6) AS tokens_usage FROM ranked
UNION ALL
SELECT 'doc', round(sum(doc_count) FILTER (WHERE doc_rank <= 100) / any_value(doc_total), 6) FROM ranked""",
    "tokens_for_coverage": f"""WITH {RANKED}
SELECT min(term_rank) AS n_tokens FROM ranked WHERE term_sum * 2 >= term_total""",
    "tokens_for_coverage_uneven": f"WITH {RANKED} " + " UNION ALL ".join(
        f"SELECT '{share} {stat}_freq' AS kind, min({stat}_rank) AS n_tokens FROM ranked "
        f"WHERE {stat}_sum::DECIMAL(20,0) >= {share:.6f}::DECIMAL(8,6) * {stat}_total::DECIMAL(20,0)"
        for share in R.UNEVEN_SHARES for stat in ("term", "doc")
    ),
    "coverage_table": f"""WITH {RANKED}, {coverage_sizes('term')}
SELECT size AS n_most_used,
  round((SELECT sum(term_count) FROM ranked WHERE term_rank <= size) / (SELECT any_value(term_total) FROM ranked), 6)
    AS cumulative_term_freq,
  round((SELECT sum(doc_count) FROM ranked WHERE doc_rank <= size) / (SELECT any_value(doc_total) FROM ranked), 6)
    AS doc_coverage
FROM sizes""",
    "corpus_stats": f"""WITH {WORDS}, pct AS (SELECT 100.0 * doc_freq AS p FROM tf), fences AS (
  SELECT quantile_cont(p, 0.25) AS q25, quantile_cont(p, 0.5) AS q50, quantile_cont(p, 0.75) AS q75 FROM pct
)
SELECT count(*) AS n_tokens, round(100.0::DOUBLE / (SELECT n FROM n_docs), 6) AS one_doc_freq, round(avg(p), 6) AS mean,
  round(stddev_samp(p), 6) AS std, round(min(p), 6) AS min, round(any_value(q25), 6) AS q25,
  round(any_value(q50), 6) AS q50, round(any_value(q75), 6) AS q75, round(max(p), 6) AS max,
  count(*) FILTER (WHERE p > q75 + 1.5 * (q75 - q25) + 1e-9 OR p < q25 - 1.5 * (q75 - q25) - 1e-9) AS outside_1_5_iqr,
  count(*) FILTER (WHERE p > q75 + 3 * (q75 - q25) + 1e-9 OR p < q25 - 3 * (q75 - q25) - 1e-9) AS outside_3_0_iqr,
  count(*) FILTER (WHERE p > q75 + 5 * (q75 - q25) + 1e-9 OR p < q25 - 5 * (q75 - q25) - 1e-9) AS outside_5_0_iqr
FROM pct, fences""",
    "rank_lookup": f"""WITH {RANKED}
SELECT doc_rank - 1 AS rank, round(doc_count / (SELECT n FROM n_docs), 6) AS doc_freq, doc_count
FROM ranked WHERE doc_rank - 1 IN (49, 258, 685)""",
    "banded_top_tokens": f"""WITH {RANKED}
SELECT token AS tokens, doc_rank AS rank, (doc_rank - 1) // 25 AS band,
  round(doc_count / (SELECT n FROM n_docs), 6) AS doc_freq, doc_count FROM ranked WHERE doc_rank <= 100""",
    "filter_term_docfreq": kept_by_doc_freq(*R.BODY_RANGE),
    "filter_term_docfreq_wide": kept_by_doc_freq(0.0015, 0.4),
    "tag_usage": f"""WITH {TAGGED}, counts AS (SELECT tag, count(*) AS n FROM tags GROUP BY tag), cum AS (
  SELECT n, row_number() OVER (ORDER BY n DESC, tag) AS r, sum(n) OVER (ORDER BY n DESC, tag ROWS UNBOUNDED PRECEDING) AS s,
    sum(n) OVER () AS total, count(*) OVER () AS all_tags FROM counts
)
SELECT round(least(10, any_value(all_tags)) / any_value(all_tags), 6) AS share_of_tags,
  round(sum(n) FILTER (WHERE r <= 10) / any_value(total), 6) AS share_of_usage,
  min(r) FILTER (WHERE s * 10 >= total * 8) AS tags_for_share FROM cum""",
    "describe_counters": describe(["Score", "ViewCount", "FavoriteCount", "AnswerCount"]),
    "frequency_cloud": f"""WITH {WORDS}
SELECT token AS tokens, round(doc_freq, 6) AS doc_freq FROM tf ORDER BY doc_count DESC, token LIMIT 200""",
    "bow_counts": f"WITH {WORDS} SELECT Id, token, count(*) AS n FROM occ GROUP BY Id, token",
    "bow_tfidf": f"""WITH {WORDS}, raw AS (
  SELECT Id, token, count(*) * (ln((1 + (SELECT n FROM n_docs)) / (1 + any_value(doc_count))) + 1) AS w
  FROM occ JOIN tc USING (token) GROUP BY Id, token
)
SELECT Id, token, round(w / sqrt(sum(w * w) OVER (PARTITION BY Id)), 6) AS weight FROM raw""",
    "bow_vectors": f"""WITH {WORDS}, vocab AS (
  SELECT token FROM tf WHERE doc_freq > CAST('{R.BODY_RANGE[0]}' AS DOUBLE) AND doc_freq < CAST('{R.BODY_RANGE[1]}' AS DOUBLE)
)
SELECT words.Id, count(DISTINCT vocab.token) AS n_terms, CASE WHEN count(vocab.token) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm
FROM words LEFT JOIN occ ON occ.Id = words.Id LEFT JOIN vocab ON vocab.token = occ.token GROUP BY words.Id""",
    "word_dictionary": f"WITH {RANKED} SELECT token, term_rank - 1 AS word_id, term_count, doc_count FROM ranked",
    "dictionary_tfidf": f"""WITH {RANKED}, raw AS (
  SELECT Id, term_rank - 1 AS word_id, count(*) * (ln((1 + (SELECT n FROM n_docs)) / (1 + any_value(doc_count))) + 1) AS w
  FROM occ JOIN ranked USING (token) GROUP BY ALL
)
SELECT Id, word_id, round(w / sqrt(sum(w * w) OVER (PARTITION BY Id)), 6) AS weight FROM raw""",
    "multilabel_binarize": f"""WITH {TAGGED}, {bits_case("SELECT DISTINCT tag FROM tags")}
SELECT Id, string_agg(CASE WHEN hit THEN '1' ELSE '0' END, '' ORDER BY k) AS bits,
  string_agg(tag, '|' ORDER BY k) FILTER (WHERE hit) AS tags FROM marked GROUP BY Id""",
    "standardize": """WITH dims AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings
)
SELECT vec_id, dim, round((v - avg(v) OVER (PARTITION BY dim)) / stddev_pop(v) OVER (PARTITION BY dim), 6) AS value FROM dims""",
    "encode_sequences": f"""WITH {SEQUENCES}, places AS (SELECT words.Id, g.pos FROM words, range({R.SEQ_LEN}) g(pos))
SELECT places.Id, string_agg(coalesce(word_id, 0)::VARCHAR, '|' ORDER BY places.pos) AS sequence
FROM places LEFT JOIN coded ON coded.Id = places.Id AND coded.pos = places.pos GROUP BY places.Id""",
    "skipgram_pairs": f"WITH {SKIPGRAMS} SELECT Id, pos, context_pos, target, context FROM grams",
    "skipgram_pairs_sampled": f"""WITH {SKIPGRAMS}, chances AS (
  SELECT *, 1e-3::DOUBLE * (target * (ln(target::DOUBLE) + 0.577::DOUBLE) + 0.5 - 1.0 / (12.0::DOUBLE * target)) AS f FROM grams
)
SELECT Id, pos, context_pos, target, context FROM chances
WHERE {uniform("'42|' || Id || '|' || pos")} < least(1.0, f / sqrt(f))""",
    "document_embedding": f"""WITH {RANKED}, vecs AS (
  SELECT token, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim
  FROM ranked JOIN embeddings ON vec_id = term_rank - 1
), sums AS (SELECT Id, dim, sum(v) AS s FROM occ JOIN vecs USING (token) GROUP BY Id, dim),
grid AS (SELECT Id, greatest(len(tokens), 1) AS n, g.dim FROM words, range({R.DIM}) g(dim))
SELECT grid.Id, grid.dim, round(coalesce(s, 0.0) / n, 6) + 0.0 AS value
FROM grid LEFT JOIN sums ON sums.Id = grid.Id AND sums.dim = grid.dim""",
    "embedding_features": f"""WITH {split(TAGGED + ", rows_ AS (SELECT Id, ntags, array_to_string(list_sort(ntags), '_') AS key_ FROM tagged)", 'key_')}
SELECT parts.Id, is_test, array_to_string(ntags, '|') AS tags,
  round(list_sum(list_transform(embedding, lambda v: v::DOUBLE)), 4) AS total
FROM parts JOIN rows_ ON rows_.Id = parts.Id JOIN embeddings ON vec_id = parts.Id""",
    "binary_relevance_equations": f"""WITH {kept_labels(50)}, used AS (
  SELECT rows_.Id, string_split(kept, '|') AS kept, embedding FROM rows_ JOIN embeddings ON vec_id = rows_.Id WHERE kept <> ''
), classes AS (SELECT DISTINCT unnest(kept) AS tag FROM used),
flat AS (SELECT Id, kept, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM used)
SELECT tag, dim, round(avg(CASE WHEN list_contains(kept, tag) THEN v ELSE -v END), 6) + 0.0 AS side
FROM flat, classes GROUP BY tag, dim""",
    "binary_relevance_equations_wide": f"""WITH {kept_labels(5)}, texts AS (SELECT Id, {body_words('Body')} AS tokens FROM posts), used AS (
  SELECT rows_.Id, string_split(kept, '|') AS kept, tokens FROM rows_ JOIN texts ON texts.Id = rows_.Id WHERE kept <> ''
), classes AS (SELECT DISTINCT unnest(kept) AS tag FROM used), n AS (SELECT count(*)::DOUBLE AS n FROM used),
counts AS (SELECT Id, token, count(*)::DOUBLE AS c FROM (SELECT Id, unnest(tokens) AS token FROM used) GROUP BY ALL),
stats AS (
  SELECT token, sum(c) / any_value(n) AS mean, sqrt(sum(c * c) / any_value(n) - (sum(c) / any_value(n)) * (sum(c) / any_value(n))) AS sd
  FROM counts, n GROUP BY token
), signs AS (SELECT Id, tag, CASE WHEN list_contains(kept, tag) THEN 1.0 ELSE -1.0 END::DOUBLE AS y FROM used, classes),
means AS (SELECT tag, avg(y) AS y FROM signs GROUP BY tag),
products AS (SELECT tag, token, sum(c * y) AS xy FROM counts JOIN signs USING (Id) GROUP BY tag, token)
SELECT tag, round(sum(CASE WHEN sd > 1e-9 THEN (xy / n.n - mean * means.y) / sd ELSE 0 END
  * (('0x' || substr(md5(token), 1, 6))::BIGINT / 16777216.0::DOUBLE)), 4) + 0.0 AS side
FROM products JOIN stats USING (token) JOIN means USING (tag), n GROUP BY tag""",
    "pca_norms": """WITH flat AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings),
stats AS (SELECT dim, avg(v) AS mean, stddev_pop(v) AS sd FROM flat GROUP BY dim)
SELECT vec_id, round(sum(((v - mean) / sd) * ((v - mean) / sd)), 4) + 0.0 AS squares, 1.0::DOUBLE AS shares
FROM flat JOIN stats USING (dim) GROUP BY vec_id""",
    "label_filter": f"WITH {kept_labels(8)} SELECT Id, kept AS tags FROM rows_",
    "stratified_split": f"WITH {split(kept_labels(20), 'kept_key')} SELECT Id, is_test FROM parts",
    "stratified_split_lang": f"""WITH {split("rows_ AS (SELECT doc_id AS Id, lang FROM documents)", 'lang')}
SELECT Id, is_test FROM parts""",
    "jaccard_samples": f"""WITH {kept_labels(8)}
SELECT round(avg(n_kept / len(ntags)), 6) AS jaccard FROM rows_""",
    "coverage_rates": f"""WITH {TAGGED}, lists AS (SELECT Id, {body_words('Body')} AS words FROM posts),
rates AS (
  SELECT len(list_filter(['en', 'que', 'ander'], lambda p: list_contains(ntags, p))) / len(list_distinct(ntags)) AS t,
    len(list_filter(['en', 'que', 'ander'], lambda p: list_contains(words, p))) / nullif(len(list_distinct(words)), 0) AS w
  FROM tagged JOIN lists USING (Id)
)
SELECT round(avg(t), 6) AS tag_coverage, round(avg(w), 6) AS word_coverage FROM rates""",
    "supervised_bow_rows": test_rows(100, "TRUE AS scored"),
    "binary_relevance_rows": test_rows(50, "TRUE AS scored", vectors=True),
    "unsupervised_rows": test_rows(50, f"{R.N_TERM} AS n_terms", strata=30),
    "run_grid_rows": " UNION ALL ".join(
        f"SELECT 'Classifier-squared_error&nb_tags-{n}&scaler-{s}' AS run, Id, truth FROM ({test_rows(n, '1 AS one', vectors=True)})"
        for n in (50, 100) for s in ("True", "False")
    ),
    "lda_share_sums": f"""WITH kept AS ({kept_by_doc_freq(*R.BODY_RANGE)})
SELECT Id, 10 AS topics, tokens <> '' AS words, CASE WHEN tokens <> '' THEN 1.0 ELSE 0.0 END::DOUBLE AS share FROM kept""",
    "lda_word_mass": f"""WITH {WORDS}
SELECT token AS word, term_count::DOUBLE AS mass FROM tf
WHERE doc_freq > CAST('{R.BODY_RANGE[0]}' AS DOUBLE) AND doc_freq < CAST('{R.BODY_RANGE[1]}' AS DOUBLE)""",
    "lda_document_mass": f"""WITH {WORDS}, known AS (
  SELECT token FROM tf WHERE doc_freq > CAST('{R.BODY_RANGE[0]}' AS DOUBLE) AND doc_freq < CAST('{R.BODY_RANGE[1]}' AS DOUBLE)
), sizes AS (SELECT Id, count(*) AS n FROM occ JOIN known USING (token) GROUP BY Id)
SELECT words.Id, 10 AS topics, coalesce(n, 0)::DOUBLE AS mass FROM words LEFT JOIN sizes ON sizes.Id = words.Id""",
    "topic_selection": f"""WITH {THETA}
SELECT vec_id, topic, round(CASE WHEN r <= {R.N_TOPIC} THEN share ELSE 0 END, 6) AS by_n,
  round(CASE WHEN share > 0.15::DOUBLE THEN share ELSE 0 END, 6) AS by_p FROM ordered""",
    "predict_terms_n": f"""WITH {TERM_SCORES}, best AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, dim) AS r FROM scores
)
SELECT vec_id, {R.N_TERM} - r AS pos, term, round(prob, 6) AS prob FROM best WHERE r <= {R.N_TERM}""",
    "predict_terms_p": f"""WITH {TERM_SCORES}
SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY prob, dim DESC) - 1 AS pos, term, round(prob, 6) AS prob
FROM scores WHERE prob >= {R.P_TERM}::DOUBLE""",
    "topic_distances": f"""WITH {THETA}, {PHI}
SELECT x.topic::BIGINT AS topic_a, y.topic::BIGINT AS topic_b,
  round(sum(x.p * ln(2 * x.p / (x.p + y.p)) + y.p * ln(2 * y.p / (x.p + y.p))) / 2, 6) AS js_divergence
FROM phi x JOIN phi y ON x.dim = y.dim AND x.topic < y.topic GROUP BY x.topic, y.topic""",
    "topic_distances_sparse": f"""WITH {THETA}, {PHI}, few AS (
  SELECT topic, dim, p / sum(p) OVER (PARTITION BY topic) AS p FROM phi WHERE dim % 10 = topic OR dim % 16 = topic
), grid AS (
  SELECT x.topic AS topic_a, y.topic AS topic_b, d.dim, coalesce(f.p, 0) AS a, coalesce(g.p, 0) AS b
  FROM (SELECT DISTINCT topic FROM few) x JOIN (SELECT DISTINCT topic FROM few) y ON x.topic < y.topic
  CROSS JOIN range({R.DIM}) d(dim) LEFT JOIN few f ON f.topic = x.topic AND f.dim = d.dim
  LEFT JOIN few g ON g.topic = y.topic AND g.dim = d.dim
)
SELECT topic_a::BIGINT AS topic_a, topic_b::BIGINT AS topic_b,
  round(sum((CASE WHEN a > 0 THEN a * ln(2 * a / (a + b)) ELSE 0 END + CASE WHEN b > 0 THEN b * ln(2 * b / (a + b)) ELSE 0 END) / 2), 6)
    AS js_divergence FROM grid GROUP BY topic_a, topic_b""",
    "topic_shares": f"WITH {THETA} SELECT topic, round(avg(share), 6) AS share FROM theta GROUP BY topic",
    "param_grid": f"SELECT loss, vect, nb_tags FROM {GRID_LISTS}",
    "config_name": f"""SELECT loss, vect, nb_tags,
  'Classifier-' || loss || '&Vect-' || vect || '&nb_tags-' || nb_tags AS name FROM {GRID_LISTS}""",
    "config_name_mapped": f"""WITH lists AS (SELECT loss, vect, nb_tags FROM {GRID_LISTS}), mapped AS (
  SELECT DISTINCT CASE WHEN loss < 'es' THEN 'hinge' ELSE 'squared_error' END AS loss,
    CASE WHEN vect = 1 THEN 'count' ELSE 'tfidf' END AS vect, nb_tags FROM lists
), grid AS (SELECT mapped.*, o.nb_tags AS m FROM mapped, (SELECT DISTINCT nb_tags FROM lists) o)
SELECT loss, vect, nb_tags, 'Classifier-' || CASE loss WHEN 'hinge' THEN 'SVM' ELSE loss END || '&Vect-'
  || CASE vect WHEN 'count' THEN 'CountVectorizer' ELSE 'TfidfVectorizer' END || '&nb_tags-' || nb_tags
  || '&body_min_df-' || round(100 * (m * 0.01234567::DOUBLE), 3)::DOUBLE::VARCHAR || '%' AS name FROM grid""",
    "negative_samples": f"""WITH {SKIPGRAMS}, drawn AS (
  SELECT *, list_concat(list_transform(range(1, {4 * R.NEGATIVES} + 1), lambda j:
      (floor(exp((('0x' || substr(md5('42|' || Id || '|' || pos || '|' || context_pos || '|' || j), 1, 8))::BIGINT
        / 4294967296.0::DOUBLE) * ln({R.VOCAB + 1}::DOUBLE))) - 1)::BIGINT), range(0, {R.NEGATIVES} + 1)) AS l FROM grams
), others AS (
  SELECT *, list_filter(l, lambda x, i: x <> context AND list_position(l, x) = i)[1:{R.NEGATIVES}] AS o FROM drawn
)
SELECT Id, pos, context_pos, target, array_to_string(list_prepend(context, o), '|') AS contexts,
  '1{'|0' * R.NEGATIVES}' AS labels FROM others""",
    "direct_match": f"""WITH {KNOWN_TAGS}, words AS (SELECT Id, {body_words('Body')} AS tokens FROM posts),
p AS (SELECT Id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM words)
SELECT words.Id, coalesce(string_agg(known.token, '|' ORDER BY pos), '') AS tags
FROM words LEFT JOIN p ON p.Id = words.Id LEFT JOIN known ON known.token = p.token GROUP BY words.Id""",
    "suggest_tags": SUGGESTED,
    "suggest_tags_stream": SUGGESTED,
}
