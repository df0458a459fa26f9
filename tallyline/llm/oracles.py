"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from tallyline.llm import ball_codes, chat_format, veb_merkle

# CRC-32 of ASCII text: the reflected polynomial 0xEDB88320, a byte at a time.
_CRC_TABLE = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS crc_tab)"""


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of an ASCII expression, beside ``crc_table``."""
    codes = f"list_transform(range(length({text})), lambda i: ord(substr({text}, i + 1, 1)))"
    step = "lambda a, b: xor(a >> 8, crc_tab[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce({codes}, {step}, 4294967295), 4294967295)"


def merkle(levels: int = 5, key_levels: int = 3) -> str:
    """Leaves, roots and proofs, level by level (up to 16 to the power of ``levels`` leaves)."""

    def field(c: str) -> str:
        return f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"

    def leaf(text: str) -> str:
        parts = (text if c == "text" else c for c in veb_merkle.FIELDS)
        return "sha256(" + " || ".join(field(c) for c in parts) + ")"

    ctes = [_CRC_TABLE]
    upper, lower = (f"'{''.join(map(chr, range(a, a + 26)))}'" for a in (65, 97))
    found = f"""CASE WHEN {crc32('doc_id::varchar')} % 5 = 0
        THEN translate(text, {upper}, {lower}) ELSE text END"""
    ctes.append(f"""leaves AS (SELECT coalesce('=' || source, '') AS k, doc_id, {leaf('text')} AS leaf,
        {leaf('found')} AS claim FROM (SELECT *, {found} AS found FROM documents, crc_table))""")
    ctes.append("""placed AS (SELECT *, row_number() OVER (
        PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves)""")

    def tree(name: str, source: str, depth: int) -> None:
        ctes.append(f"""{name}_0 AS (SELECT k, pos, digest, count(*) OVER (PARTITION BY k) AS n FROM ({source}))""")
        for i in range(depth):
            ctes.append(f"""{name}_sib_{i} AS (SELECT k, pos, n,
                CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER (PARTITION BY k, pos // 16
                    ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
                CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER (PARTITION BY k, pos // 16
                    ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r
                FROM {name}_{i})""")
            ctes.append(f"""{name}_{i + 1} AS (SELECT k, pos, digest, count(*) OVER (PARTITION BY k) AS n FROM (
                SELECT k, pos // 16 AS pos, CASE WHEN any_value(n) > 1
                THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE any_value(digest) END AS digest
                FROM {name}_{i} GROUP BY k, pos // 16))""")

    tree("d", "SELECT k, pos, leaf AS digest FROM placed", levels)
    ctes.append(f"""subroots AS (SELECT k, digest AS subroot, row_number() OVER (ORDER BY k) - 1 AS place
        FROM d_{levels})""")
    tree("t", "SELECT 0 AS k, place AS pos, subroot AS digest FROM subroots", key_levels)
    previous, proof = "claim", []
    ctes.append("f_0 AS (SELECT p.*, s.subroot, s.place, claim AS folded, '' AS proof FROM placed p JOIN subroots s USING (k))")
    step = 0
    for name, place, depth, on in (("d", "pos", levels, "s.k = f.k"), ("t", "place", key_levels, "true")):
        for i in range(depth):
            ctes.append(f"""f_{step + 1} AS (SELECT f.* REPLACE (
                CASE WHEN s.n > 1 THEN sha256(s.l || f.folded || s.r) ELSE f.folded END AS folded,
                f.proof || s.l || s.r AS proof)
                FROM f_{step} f JOIN {name}_sib_{i} s ON {on} AND s.pos = f.{place} // {16 ** i})""")
            step += 1
    return f"""WITH {', '.join(ctes)}
        SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256,
            folded AS folded_root, folded = t.digest AS verified
        FROM f_{step} f, t_{key_levels} t"""


def chats() -> str:
    marks = (*chat_format.CONTROL, *chat_format.FOREIGN)

    def quoted(text: str) -> str:
        return "".join("\\" + c if c in "[]|<>/" and c in "[]|" else c for c in text)

    pattern = "|".join(f"{quoted(m[0])}\\\\*{quoted(m[1:])}" for m in marks)
    escaped = "(length({0}) + length(regexp_extract_all({0}, '" + pattern + "')))"
    fixed = " ".join(
        f"WHEN '{role}' THEN {len(a) + len(b)}" for role, (a, b) in chat_format.TURN_MARKS.items())
    other = len(chat_format.OTHER_ROLE + chat_format.ROLE_END + chat_format.OTHER_END)
    said = "</s>[INST] ok [/INST]"
    return f"""WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{said}' UNION ALL SELECT -1, 1, 'assistant', '{said}')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
            cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
            cast({len(chat_format.BEGIN)} + sum({escaped.format('text')} + CASE role {fixed}
                ELSE {other} + {escaped.format('role')} END) AS bigint) AS formatted_chars
        FROM turns GROUP BY conv_id"""


def codes() -> str:
    """Lloyd's rounds over all entries; whole numbers as doubles, which are exact here."""
    parts, rounds = ball_codes.PARTS, ball_codes.ROUNDS
    ctes = [f"""kept AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS rn,
            list_transform(embedding, lambda x: floor(x::double * {ball_codes.SCALE})) AS v FROM embeddings
            WHERE list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
        split AS (SELECT rn, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS x
            FROM kept, range({parts}) AS t(p)),
        book_0 AS (SELECT p, rn - 1 AS e, x AS c FROM split WHERE rn <= {ball_codes.ENTRIES})"""]
    for i in range(rounds + 1):
        ctes.append(f"""near_{i} AS MATERIALIZED (SELECT rn, s.p, any_value(x) AS x, min(struct_pack(
                d := list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), e := e)) AS b
            FROM split s JOIN book_{i} k ON s.p = k.p GROUP BY rn, s.p)""")
        if i < rounds:
            ctes.append(f"""mean_{i} AS (SELECT p, e, list(m ORDER BY j) AS c FROM (
                SELECT p, b.e AS e, j, floor(sum(x[j]) / count(*)) AS m
                FROM near_{i}, unnest(range(1, len(x) + 1)) AS u(j) GROUP BY ALL) GROUP BY p, e),
            book_{i + 1} AS MATERIALIZED (SELECT k.p, k.e, coalesce(m.c, k.c) AS c
                FROM book_{i} k LEFT JOIN mean_{i} m ON k.p = m.p AND k.e = m.e)""")
    return f"""WITH {', '.join(ctes)},
        coded AS (SELECT rn, string_agg(printf('%02x', b.e), '' ORDER BY p) AS code,
            cast(sum(b.d) AS bigint) AS error FROM near_{rounds} GROUP BY rn),
        digest AS (SELECT sha256(string_agg(cast(cast(c[j] AS bigint) AS varchar), ',' ORDER BY p, e, j)) AS h
            FROM book_{rounds}, unnest(range(1, len(c) + 1)) AS u(j))
        SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error,
            h AS codebooks_sha256
        FROM kept JOIN coded USING (rn), digest"""
