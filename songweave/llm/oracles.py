"""SQL that text operators are checked against, where it takes more than a few lines."""

from __future__ import annotations

FANOUT = 8
# Levels that the SQL climbs: more than any table it runs on needs.
LEVELS, KEY_LEVELS = 8, 3

CRC32 = """
    list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))
"""


def _field(value: str) -> str:
    text = f"cast({value} as varchar)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _digest(*values: str) -> str:
    return "sha256(" + " || ".join(map(_field, values)) + ")"


def _climb(name: str, nodes: str, walkers: str, levels: int) -> list[str]:
    """Tables ``<name>_<level>``, the nodes (tree, pos, node, nodes) of each level, and
    ``<name>_walk_<level>``, the walkers (tree, pos, folded, sibs and more) on their way up."""
    parts = [
        f"{name}_0 as (select tree, pos, node, nodes from {nodes})",
        f"{name}_walk_0 as (select *, pos as place from {walkers})",
    ]
    for k in range(levels):
        before = "array_to_string(list[:place % 8], '')"
        after = "array_to_string(list[place % 8 + 2:], '')"
        parts += [
            f"{name}_runs_{k} as (select tree, pos // {FANOUT} as run, any_value(nodes) as many, "
            f"list(node order by pos) as list from {name}_{k} group by all)",
            f"{name}_{k + 1} as (select tree, run as pos, case when many > 1 "
            f"then sha256(array_to_string(list, '')) else list[1] end as node, "
            f"(many + {FANOUT - 1}) // {FANOUT} as nodes from {name}_runs_{k})",
            f"{name}_walk_{k + 1} as (select w.* exclude (folded, sibs, place), "
            f"case when many > 1 then sha256({before} || folded || {after}) else folded end as folded, "
            f"case when many > 1 then sibs || {before} || {after} else sibs end as sibs, "
            f"place // {FANOUT} as place from {name}_walk_{k} w join {name}_runs_{k} r "
            f"on w.tree = r.tree and place // {FANOUT} = run)",
        ]
    return parts


def merkle() -> str:
    upper, lower = ("".join(map(chr, range(ord(c), ord(c) + 26))) for c in "Aa")
    fields = ["doc_id", "source", "lang", "n_chars"]
    parts = [
        f"crc as (select {CRC32} as steps)",
        f"leaves as (select doc_id, lang, {_digest(*fields, 'text')} as leaf, "
        f"{_digest(*fields, f"translate(text, '{upper}', '{lower}')")} as lowered, "
        "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform("
        "string_split(cast(doc_id as varchar), ''), lambda c: ascii(c))), "
        "lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) as crc from documents, crc)",
        "placed as (select doc_id, dense_rank() over (order by lang nulls first) as tree, "
        "row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, "
        "leaf as node, count(*) over (partition by lang) as nodes, "
        "case when crc % 3 = 0 then lowered else leaf end as folded, '' as sibs from leaves)",
        *_climb("doc", "placed", "placed", LEVELS),
        f"subroots as (select 0 as tree, tree - 1 as pos, node, count(*) over () as nodes, "
        f"node as subroot from doc_{LEVELS})",
        "lifted as (select w.doc_id, w.node as leaf, s.tree, s.pos, s.subroot, "
        f"w.folded, w.sibs from doc_walk_{LEVELS} w join subroots s on w.tree = s.pos + 1)",
        *_climb("key", "subroots", "lifted", KEY_LEVELS),
    ]
    return "with " + ",\n".join(parts) + f"""
        select doc_id, leaf, subroot, root.node as root, sha256(sibs) as proof_sha256,
               folded as folded_root, folded = root.node as verified
        from key_walk_{KEY_LEVELS}, key_{KEY_LEVELS} as root
    """


def jaccard(k: int, num: int, den: int) -> str:
    """Components of documents whose sets of ``k``-word shingles overlap by num / den or more."""
    upper, lower = ("".join(map(chr, range(ord(c), ord(c) + 26))) for c in "Aa")
    return f"""
        with recursive worded as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') as words
            from documents
        ), sets as (
            select doc_id, case when len(words) = 0 then [] else list_distinct(list_transform(
                range(1, greatest(len(words) - {k - 1}, 1) + 1),
                lambda i: array_to_string(words[i:i + {k - 1}], ' '))) end as shingles
            from worded
        ), elements as (
            select doc_id, len(shingles) as n, unnest(shingles) as shingle from sets
        ), links as (
            select a.doc_id as one, b.doc_id as two
            from elements a join elements b on a.shingle = b.shingle and a.doc_id <> b.doc_id
            group by a.doc_id, b.doc_id
            having {den} * count(*) >= {num} * (any_value(a.n) + any_value(b.n) - count(*))
        ), reached as (
            select doc_id, doc_id as other from documents
            union
            select r.doc_id, l.two from reached r join links l on r.other = l.one
        ), components as (select doc_id, min(other) as component_id from reached group by doc_id)
        select s.doc_id, len(shingles) as n_shingles, component_id
        from sets s join components c on s.doc_id = c.doc_id
    """


def chat(hostile: str) -> str:
    """What formatted conversations hold, and one more of the template's own control strings."""
    start, end = len("<|im_start|>"), len("<|im_end|>")
    marked = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"
    role = "replace(replace(role, '\\', '\\\\'), chr(10), '\\n')"
    return f"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
            from conversations
            union all select -1, 0, 'user', '{hostile}'
            union all select -1, 1, 'assistant', '{hostile}'
        ), sized as (
            select *, {start + end + 2} + length({marked.format(role)})
                      + length({marked.format("text")}) as chars
            from turns
        ), placed as (
            select *, sum(chars) over (partition by conv_id order by turn nulls first, role, text
                                       rows unbounded preceding) as so_far
            from sized
        )
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), ''
                                 order by turn nulls first, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
                               filter (role = 'assistant'), '')) as loss_sha256,
               sum(chars)::bigint as formatted_chars,
               count(*) filter (role = 'assistant') as examples,
               coalesce(sum(so_far) filter (role = 'assistant'), 0)::bigint as expanded_chars
        from placed group by conv_id
    """
