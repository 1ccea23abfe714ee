"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

from talkscout.llm import quality

ORACLES: dict[str, str] = {}


def _quality() -> str:
    stops = ", ".join("'" + w + "'" for w in quality._forms(quality.STOP_WORDS))
    bounds = {r.name: r for r in quality.RULES}

    def rule(name: str, value: str) -> str:
        r = bounds[name]
        tests = [f"{value} >= {r.low}"] * (r.low is not None) + [f"{value} <= {r.high}"] * (r.high is not None)
        return f"(n_words < {r.min_words} OR ({' AND '.join(tests)}))"

    ratio = lambda a, b: f"(CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0.0 END)"
    rules = {
        "mean_word": rule("mean_word", ratio("word_chars", "n_words")),
        "symbols": rule("symbols", ratio("n_symbols", "word_chars")),
        "stop_words": rule("stop_words", ratio("n_stop", "n_words")),
        "lines": rule("lines", ratio("n_dup_lines", "n_lines")),
        "stutter": rule("stutter", ratio("n_stutter", "n_words")),
    }
    failed = ", ".join(f"CASE WHEN NOT {test} THEN '{name}' END" for name, test in rules.items())
    return f"""
    WITH split AS (
        SELECT doc_id, coalesce(text, '') AS t,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
        FROM documents),
    windows AS (
        SELECT doc_id, unnest(range(1, len(w) - 3)) AS pos, w FROM split WHERE len(w) >= 5),
    keyed AS (SELECT doc_id, pos, list_slice(w, pos, pos + 4) AS k FROM windows),
    repeated AS (
        SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, k) AS n FROM keyed) WHERE n > 1),
    covered AS (
        SELECT doc_id, count(*) AS n FROM (
            SELECT DISTINCT doc_id, pos + j AS p FROM repeated, (SELECT unnest(range(0, 5)) AS j)) GROUP BY doc_id),
    counts AS (
        SELECT s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
            (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
            len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
            coalesce(c.n, 0)::BIGINT AS n_repeat_words,
            len(list_filter(w, lambda x: x IN ({stops}))) AS n_stop,
            len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutter
        FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id),
    judged AS (
        SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM counts)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        (NOT base_failed AND {" AND ".join(rules.values())}) AS kept,
        array_to_string(list_filter([{failed}], lambda x: x IS NOT NULL), ',') AS failed_rules
    FROM judged"""


ORACLES["op10_quality_rules"] = _quality()

_SEGMENT = """
    length(t) + length(t) - length(replace(t, '\\', ''))
        + len(regexp_extract_all(t, '<s>|</s>|\\[/?INST\\]|<</?SYS>>|<</?ROLE'))
        + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 19 WHEN 'assistant' THEN 7 ELSE
            20 + length(role) + length(role) - length(replace(replace(role, '\\', ''), '>', ''))
            + len(regexp_extract_all(role, '<s>|</s>|\\[/?INST\\]|<</?SYS>>|<</?ROLE')) END"""

ORACLES["op1_chat_formatting"] = f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    placed AS (
        SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS all_turns,
            sum({_SEGMENT}) OVER (w ROWS UNBOUNDED PRECEDING) AS chars
        FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, t))
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY n)) AS turns_sha256,
        coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(t, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
        coalesce(sum(chars) FILTER (role = 'assistant' OR n = all_turns), 0)::BIGINT AS formatted_chars,
        count(*) FILTER (role = 'assistant' OR n = all_turns) AS n_examples
    FROM placed GROUP BY conv_id"""

ORACLES["op2_warc_salvage"] = """
    WITH hashed AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS bytes, sha1(coalesce(html, '')) AS h FROM pages),
    firsts AS (SELECT h, min(page_id) AS first FROM hashed GROUP BY h)
    SELECT page_id, bytes AS payload_bytes,
        array_to_string(list_transform(range(0, 32), lambda i:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM hashed JOIN firsts USING (h)"""

ORACLES["op3_maxscore"] = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND coalesce(list_sum(list_transform(embedding, lambda x: 65536.0::DOUBLE * x::DOUBLE * x::DOUBLE)), 0) < 4611686018427387904.0::DOUBLE),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5"""

ORACLES["op4_near_duplicates"] = """
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
            lambda x: x <> '') AS w
        FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE
            list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
    items AS (SELECT doc_id, unnest(s) AS x FROM sets),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM common JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
        WHERE 100 * n >= 80 * (len(p.s) + len(q.s) - n)),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    firsts AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN firsts ON a = doc_id"""


def _repair() -> str:
    # A path is its cost in nine digits and its letters: the least string is the cheapest, then the ASCII-least one.
    step = lambda cost, letter, path: f"lpad((left({path}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{letter}' || substr({path}, 10)"
    both = lambda path: step(10, "II", path)

    def row(state: int, keeps: dict[str, int], to: int) -> str:
        keep = " ".join(f"WHEN initial = '{c}' THEN {step('extra', 'K', f's{q}')}" for c, q in keeps.items())
        return (
            f"least({step(2, 'D', f's{state}')}, CASE WHEN must_go THEN NULL {keep} END, "
            f"CASE WHEN NOT must_go THEN {step('extra + 1', 'R', f's{to}')} END) AS b{state}"
        )

    rows = ", ".join([row(0, {"s": 1, "u": 2}, 2), row(1, {"u": 2}, 2), row(2, {"a": 3}, 3), row(3, {"u": 2}, 2)])
    inserted = (
        f"least(b0, {step(5, 'I', 'b2')}, {both('b3')}) AS s0, least(b1, {step(5, 'I', 'b2')}, {both('b3')}) AS s1, "
        f"least(b2, {step(5, 'I', 'b3')}) AS s2, least(b3, {step(5, 'I', 'b2')}) AS s3"
    )
    return f"""
    WITH RECURSIVE bits AS (
        SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
        FROM range(256) r(i)),
    keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
            [4294967295] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
        FROM conversations, bits),
    damaged AS (
        SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM keyed WHERE kind <> 0),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS initial FROM damaged),
    marked AS (
        SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
            NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
            lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
        FROM placed),
    judged AS (
        SELECT *, is_blank OR again AS must_go, CASE WHEN cut AND NOT is_blank AND NOT again THEN 5 ELSE 0 END AS extra FROM marked),
    facts AS (
        SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (is_blank) AS blank, count(*) FILTER (again AND NOT is_blank) AS duplicate,
            count(*) FILTER (extra > 0) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM judged GROUP BY conv_id),
    paths AS (
        SELECT conv_id, n + 1 AS i, '000000000' AS s0, '000000010II' AS s1, '000000005I' AS s2, '000000000' AS s3 FROM facts
        UNION ALL
        SELECT conv_id, i, {inserted} FROM (
            SELECT p.conv_id, j.i, {rows} FROM paths p JOIN judged j ON p.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = p.i - 1)),
    best AS (SELECT conv_id, left(s0, 9)::BIGINT AS cost, substr(s0, 10) AS audit FROM paths WHERE i = 1),
    letters AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j, audit[j] AS letter FROM best),
    edits AS (
        SELECT conv_id, j, letter, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS k
        FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
    lines AS (
        SELECT e.conv_id, e.j, e.k, e.letter, r.role, CASE WHEN e.letter = 'I' THEN '' ELSE r.text END AS text,
            max(CASE WHEN e.k = 1 AND e.letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS head
        FROM edits e LEFT JOIN judged r ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.i = r.i WHERE e.letter <> 'D'),
    texts AS (
        SELECT conv_id, count(*) AS kept, string_agg(
            CASE WHEN letter = 'K' THEN role WHEN (k - head) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS t
        FROM lines GROUP BY conv_id)
    SELECT c.conv_id, coalesce(f.gaps, 0)::BIGINT AS gaps, coalesce(f.blank, 0)::BIGINT AS blank, coalesce(f.duplicate, 0)::BIGINT AS duplicate,
        coalesce(f.truncated, 0)::BIGINT AS truncated, coalesce(f.illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
        coalesce(b.audit, '') AS audit, sha256(coalesce(t.t, '')) AS repaired_sha256, coalesce(f.n, 0)::BIGINT AS n_turns, coalesce(t.kept, 0)::BIGINT AS kept
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN facts f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
    LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
    LEFT JOIN texts t ON c.conv_id IS NOT DISTINCT FROM t.conv_id"""


ORACLES["op11_conversation_repair"] = _repair()
