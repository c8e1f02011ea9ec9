"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from sharelens.llm.chat_format import CONTROL, END, LEARNED_ROLE, START

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _reachable(nodes: str, links: str) -> str:
    """CTEs ``both`` and ``component``: the smallest id reachable by ``links`` (``a, b``)."""
    return f"""
        both_ways AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
        reach(id, seen) AS (
            SELECT id, id FROM {nodes} UNION SELECT l.b, r.seen FROM reach r JOIN both_ways l ON l.a = r.id),
        component AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY 1)"""


_CHARS = " + ".join(
    f"(length(text) - length(replace(text, {_quoted(c)}, ''))) // {len(c)}" for c in [*CONTROL, "\\"]
)
_MARKS = len(START) + len(END) + 2
_SAID = _quoted("</s>[INST] ok [/INST]")

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ABOVE = "list_transform(range((len(h) + 1) // 2), lambda i: sha256(h[2 * i + 1] || coalesce(h[2 * i + 2], '')))"


def _leaf(n_chars: str) -> str:
    """The digest of a row of ``documents``: each value with its size in bytes."""
    values = [f"CAST({v} AS VARCHAR)" for v in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)})"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: list_transform(range(8), lambda i: (ascii(c) >> i) & 1)))"
    step = "lambda r, b: xor(r >> 1, 3988292384 * (xor(r, b) & 1))"
    return f"xor(list_reduce({bits}, {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


ORACLE_SQL = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op3_ngram_jaccard_join": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\\x09-\\x0D\\x20]+'),
                lambda x: x <> '') AS w FROM documents),
        sets AS (
            SELECT doc_id AS id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
            FROM words),
        posts AS (SELECT id, len(s) AS n, unnest(s) AS g FROM sets),
        links AS (
            SELECT a.id AS a, b.id AS b FROM posts a JOIN posts b ON a.g = b.g AND a.id < b.id
            GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        {_reachable("sets", "links")}
        SELECT id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN component USING (id)
    """,
    "op8_embedding_near_dedup": f"""
        WITH RECURSIVE vectors AS (
            SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v,
                   coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                            AND list_max(list_transform(embedding, lambda x: abs(x))) > 0, FALSE) AS usable
            FROM embeddings),
        links AS (
            SELECT a.id AS a, b.id AS b FROM vectors a JOIN vectors b
            ON a.label = b.label AND a.id < b.id AND a.usable AND b.usable AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
        {_reachable("vectors", "links")},
        linked AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY 1)
        SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
        FROM vectors JOIN component USING (id) LEFT JOIN linked USING (id)
    """,
    "op10_chat_format": f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-1, 0, 'user', {_SAID}), (-1, 1, '{LEARNED_ROLE}', {_SAID})),
        sized AS (SELECT *, length(text) + {_CHARS} + length(role) + {_MARKS} AS chars FROM turns),
        convs AS (
            SELECT conv_id, count(*) AS n_turns, CAST(sum(chars) AS BIGINT) AS formatted_chars,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = '{LEARNED_ROLE}'), '') AS loss
            FROM sized GROUP BY 1)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
               sha256(loss) AS loss_sha256, formatted_chars, TRUE AS in_place FROM convs
    """,
    "op12_ranked_search": f"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS w
            FROM documents),
        totals AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM words),
        asked AS (
            SELECT DISTINCT item_id,
                   unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}')) AS term
            FROM benchmark),
        posts AS (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM words),
        counts AS (SELECT doc_id, n, term, count(*) AS tf FROM posts GROUP BY ALL),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
            FROM counts, totals GROUP BY term, n_docs),
        scores AS (
            SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf)
                       // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN counts USING (term), totals GROUP BY 1, 2)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 10
    """,
    "op13_merkle_manifest": f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
                   CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 AND n_chars IS NOT NULL
                        THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS start
            FROM documents),
        tree(lang, lvl, h) AS (
            SELECT lang, 0, list(leaf ORDER BY doc_id) FROM leaves GROUP BY lang
            UNION ALL SELECT lang, lvl + 1, {_ABOVE} FROM tree WHERE len(h) > 1),
        subroots AS (
            SELECT lang, h[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx FROM tree WHERE len(h) = 1),
        crown(lvl, h) AS (
            SELECT 0, list(subroot ORDER BY idx) FROM subroots
            UNION ALL SELECT lvl + 1, {_ABOVE} FROM crown WHERE len(h) > 1),
        placed AS (
            SELECT l.*, subroot, s.idx AS tree_idx, row_number() OVER (PARTITION BY l.lang ORDER BY doc_id) - 1 AS idx
            FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang),
        path AS (
            SELECT doc_id, 0 AS part, lvl, (idx >> lvl) & 1 AS side, h[xor(idx >> lvl, 1) + 1] AS sibling
            FROM placed p JOIN tree t ON p.lang IS NOT DISTINCT FROM t.lang AND len(h) > 1
            UNION ALL SELECT doc_id, 1, lvl, (tree_idx >> lvl) & 1, h[xor(tree_idx >> lvl, 1) + 1]
            FROM placed JOIN crown ON len(h) > 1),
        paths AS (
            SELECT doc_id, list(CASE side WHEN 1 THEN 'R' ELSE 'L' END || coalesce(sibling, '') ORDER BY part, lvl) AS steps
            FROM path GROUP BY 1),
        folded AS (
            SELECT p.*, root, coalesce(steps, []) AS steps, list_reduce(coalesce(steps, []),
                lambda n, s: sha256(CASE s[1] WHEN 'R' THEN s[2:] || n ELSE n || s[2:] END), start) AS folded_root
            FROM placed p LEFT JOIN paths USING (doc_id), (SELECT h[1] AS root FROM crown WHERE len(h) = 1))
        SELECT doc_id, leaf, subroot, root,
               sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM folded
    """,
}
