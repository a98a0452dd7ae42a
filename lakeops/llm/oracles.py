"""SQL counterparts of the queries that SQL can express, for the same tables."""

from __future__ import annotations

from lakeops.llm.chat import END, START
from lakeops.llm.queries import CONTROL

_ESCAPED = r"replace(replace({}, '\', '\\'), '<|', '<\|')"

ORACLES: dict[str, str] = {
    "op1_chat_formatting": f"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce("text", '') as said
            from conversations
            union all select -1, 0, 'user', '{CONTROL}'
            union all select -1, 1, 'assistant', '{CONTROL}'
        ),
        joined as (
            select conv_id, count(*) as n_turns,
                string_agg(role || chr(10) || said || chr(10), '' order by turn, role, said) as whole,
                coalesce(string_agg(said, '' order by turn, role, said) filter (role = 'assistant'), '') as loss,
                count(*) filter (role = 'assistant') as n_examples,
                sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("said")}) + {len(START) + 1 + len(END)})
                    as formatted_chars
            from turns group by conv_id
        )
        select conv_id, n_turns, sha256(whole) as turns_sha256, length(loss) as loss_chars,
            sha256(loss) as loss_sha256, formatted_chars::bigint as formatted_chars, n_examples
        from joined
    """,
    "op6_substring_dedup": r"""
        with docs as (
            select doc_id, regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') as words from documents
        ),
        windows as (
            select doc_id, s, array_to_string(words[s : s + 19], ' ') as w
            from (select doc_id, words, unnest(range(1, len(words) - 18)) as s from docs)
        ),
        later as (
            select doc_id, s
            from (
                select doc_id, s, row_number() over (partition by w order by doc_id, s) as n from windows
            ) where n > 1
        ),
        gone as (select distinct doc_id, unnest(range(s, s + 20)) as i from later),
        listed as (select doc_id, unnest(range(1, len(words) + 1)) as i, unnest(words) as word from docs),
        kept as (
            select doc_id, string_agg(word, ' ' order by i) as kept, count(*) as n
            from listed anti join gone using (doc_id, i) group by doc_id
        )
        select doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n, 0))::bigint as n_removed,
            sha256(coalesce(kept, '')) as kept_sha256
        from docs left join kept using (doc_id)
    """,
    "op11_embedding_dedup": """
        with recursive usable as (
            select vec_id, label, e from (select vec_id, label, cast(embedding as double[]) as e from embeddings)
            where label is not null and len(e) > 0
                and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
                and len(list_filter(e, lambda x: x <> 0)) > 0
        ),
        links as (
            select a.vec_id as a, b.vec_id as b from usable as a join usable as b
                on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
                and list_cosine_similarity(a.e, b.e) >= 0.98
        ),
        reached as (
            select a, b from links
            union
            select reached.a, links.b from reached join links on reached.b = links.a
        ),
        least as (select a, min(b) as b from reached group by a),
        counted as (select a, count(*) as n from links group by a)
        select vec_id, coalesce(n, 0)::bigint as n_links, least(vec_id, coalesce(b, vec_id)) as component_id,
            vec_id <= coalesce(b, vec_id) as kept
        from embeddings left join least on least.a = vec_id left join counted on counted.a = vec_id
    """,
}
