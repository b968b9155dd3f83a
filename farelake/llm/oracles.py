"""The operators' results in plain SQL, where SQL can express them.

Not here: the encoders and packing (token ids are no SQL), the language, compression and licence
models, the spans of personal data, whose patterns look around, and periodic runs, whose periods are
compared at every distance. Those are tested against brute force, round trips or held-out accuracy.
"""

from __future__ import annotations

from farelake.llm.quality_rules import CAPITALS, MARKS, MIN_WORDS, REACH, RULES, SYMBOLS

BLANK = r"[ \t\n\x0B\f\r]+"


def words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{BLANK}'), lambda x: x <> '')"


#: From `links` (a, b) and `nodes` (id): the smallest id reachable.
REACH_SQL = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (
    SELECT id, id FROM nodes
    UNION
    SELECT r.id, l.b FROM reach r JOIN both_ways l ON l.a = r.other
),
found AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MINHASH = f"""
WITH RECURSIVE lists AS (
    SELECT doc_id, {words(f"translate(text, '{LETTERS}', '{LETTERS.lower()}')")} AS w FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) END AS grams
    FROM lists
),
grams AS (SELECT doc_id, unnest(grams) AS gram FROM sets),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM shared JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
    WHERE 100 * n >= 85 * (len(p.grams) + len(q.grams) - n)
),
nodes AS (SELECT doc_id AS id FROM documents),
{REACH_SQL}
SELECT doc_id, len(grams) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN found ON id = doc_id
"""

VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id
    WHERE list_cosine_similarity(x.e, y.e) >= 0.95
),
nodes AS (SELECT vec_id AS id FROM v),
{REACH_SQL},
counted AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM found LEFT JOIN counted ON a = id
"""

SUBSTRINGS = f"""
WITH lists AS (SELECT doc_id, {words("text")} AS w FROM documents),
windows AS (
    SELECT doc_id, i, w[i:i + 19] AS passage FROM lists, unnest(range(1, len(w) - 18)) AS t(i)
),
later AS (
    SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) > 1
),
gone AS (SELECT DISTINCT doc_id, k FROM later, unnest(range(i, i + 20)) AS t(k)),
lost AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id),
kept AS (
    SELECT doc_id, len(w) AS n_words, coalesce(len(ks), 0) AS n_removed,
        list_filter(w, lambda x, i: ks IS NULL OR NOT list_contains(ks, i)) AS stay
    FROM lists LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(stay, ' ')) AS kept_sha256 FROM kept
"""


def _quality() -> str:
    def share(part: str, whole: str, unit: int, name: str) -> str:
        return f"({unit} * {part}) // greatest({whole}, 1) AS {name}"

    def fences(keys: str, name: str) -> str:
        by = f"{keys}, rule" if keys else "rule"
        ends = []
        for rule, (below, above) in RULES.items():
            here = f"FILTER (WHERE rule = '{rule}')"
            if below is not None:
                ends.append(f"max(q1 - {REACH} * (q3 - q1) - {below}) {here} AS {rule}_low")
            ends.append(f"max(q3 + {REACH} * (q3 - q1) + {above}) {here} AS {rule}_high")
        return f"""
        {name}_quartiles AS (
            SELECT {by}, max(docs) AS docs, min(bucket) FILTER (WHERE 4 * upto >= docs) AS q1,
                min(bucket) FILTER (WHERE 4 * upto >= 3 * docs) AS q3
            FROM (
                SELECT {by}, bucket, sum(n) OVER (PARTITION BY {by}) AS docs,
                    sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS upto
                FROM (SELECT {by}, bucket, sum(n) AS n FROM sketch GROUP BY ALL)
            ) GROUP BY {by}
        ),
        {name} AS (SELECT {keys + ',' if keys else ''} max(docs) AS docs, {', '.join(ends)}
            FROM {name}_quartiles {'GROUP BY ' + keys if keys else ''})"""

    bits = "(length(bin(value)) - 6)"
    inside = []
    for rule, (below, _) in RULES.items():
        for side, sign in (("low", ">="), ("high", "<=")):
            if side == "high" or below is not None:
                name = f"{rule}_{side}"
                inside.append(
                    f"{rule} {sign} CASE WHEN own.docs >= 200 THEN own.{name} "
                    f"WHEN by_lang.docs >= 200 THEN by_lang.{name} ELSE corpus.{name} END"
                )
    lines = rf"list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]'))"

    def removed(letters: str) -> str:
        return f"length(t) - length(translate(t, '{letters}', ''))"

    return f"""
    WITH base AS (
        SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t,
            row_number() OVER () AS row FROM documents
    ),
    split AS (SELECT *, {words("t")} AS w, {lines} AS ls FROM base),
    windows AS (SELECT row, i, w[i:i + 2] AS gram FROM split, unnest(range(1, len(w) - 1)) AS u(i)),
    again AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, gram) > 1),
    repeated AS (
        SELECT row, count(DISTINCT k) AS n FROM again, unnest(range(i, i + 3)) AS u(k) GROUP BY row
    ),
    counted AS (
        SELECT doc_id, lang, source, len(w) AS n_words,
            length(regexp_replace(t, '{BLANK}', '', 'g')) AS word_chars, {removed(SYMBOLS)} AS n_symbols,
            len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines,
            {removed(CAPITALS)} AS n_capitals, {removed(MARKS)} AS n_marks
        FROM split LEFT JOIN repeated USING (row)
    ),
    measured AS (
        SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
            {share("word_chars", "n_words", 10, "word_length")}, {share("n_symbols", "word_chars", 1000, "symbols")},
            {share("n_marks", "word_chars", 1000, "marks")}, {share("n_capitals", "word_chars", 1000, "capitals")},
            {share("n_dup_lines", "n_lines", 1000, "dup_lines")}, {share("n_repeat_words", "n_words", 1000, "repeats")}
        FROM counted
    ),
    sketch AS (
        SELECT lang, source, rule, CASE WHEN value < 64 THEN value ELSE (value >> {bits}) << {bits} END AS bucket,
            count(*) AS n
        FROM (UNPIVOT (SELECT lang, source, {', '.join(RULES)} FROM measured WHERE n_words > 0)
            ON {', '.join(RULES)} INTO NAME rule VALUE value)
        GROUP BY ALL
    ),
    {fences("lang, source", "own")}, {fences("lang", "by_lang")}, {fences("", "corpus")}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        coalesce(NOT base_failed AND {' AND '.join(inside)}, false) AS kept
    FROM measured m LEFT JOIN own USING (lang, source) LEFT JOIN by_lang USING (lang) CROSS JOIN corpus
    """


def terms(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{LETTERS}', '{LETTERS.lower()}')"
    return rf"list_filter(string_split_regex({lowered}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {terms("text")} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {terms("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
wanted AS (
    SELECT DISTINCT item, w[k:k + 9] AS win FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(k)
    WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT len(win) AS s FROM wanted),
there AS (
    SELECT doc_id, k, s, w[k:k + s - 1] AS win FROM d, sizes, unnest(range(1, len(w) - s + 2)) AS t(k)
),
hits AS (SELECT doc_id, k, s, item FROM there JOIN wanted USING (win)),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(k, k + s)) AS t(p) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

RANKED_SEARCH = f"""
WITH d AS (SELECT doc_id, {terms("text")} AS w FROM documents),
lengths AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
totals AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths),
held AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
spread AS (SELECT term, count(*) AS df FROM held GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({terms("text")}) AS term FROM benchmark WHERE item_id IS NOT NULL),
scored AS (
    SELECT item_id, doc_id, CAST(sum(
        CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * all_docs) // all_terms)))
    ) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN spread USING (term) JOIN lengths USING (doc_id) CROSS JOIN totals
    GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
    doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""

ORACLES: dict[str, str] = {
    "op3_minhash": MINHASH,
    "op4_vectors": VECTORS,
    "op5_quality_rules": _quality(),
    "op8_substrings": SUBSTRINGS,
    "op12_decontamination": DECONTAMINATION,
    "op13_ranked_search": RANKED_SEARCH,
}
