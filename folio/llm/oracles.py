"""DuckDB SQL of those training-data queries that SQL can express."""

from __future__ import annotations

import math
import string

from folio.llm.line_dedup import LONG_LINE
from folio.llm.licenses import CONTAINMENT, PHRASES, TEMPLATES, reach_of

SPACE = "[ \\t\\n\\x0B\\f\\r]"

SUBSTRING_DEDUP = f"""with w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}+'), lambda x: x <> '') as ws from documents),
    k as (select doc_id, i, md5(array_to_string(list_slice(ws, i, i + 12), ' ')) as h
          from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 12, 0) + 1)) as i from w)),
    f as (select h, min(doc_id) as first_doc from k group by h),
    c as (select distinct doc_id, unnest(range(i, i + 13)) as p from k join f using (h) where first_doc < doc_id),
    r as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as p from w),
    s as (select r.doc_id, count(*) as n_words, count(c.p) as n_removed, string_agg(word, ' ' order by r.p) filter (where c.p is null) as kept
          from r left join c on c.doc_id = r.doc_id and c.p = r.p group by 1)
    select w.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from w left join s using (doc_id)"""

LINE_DEDUP = f"""with a as (select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as p from documents where text <> ''),
    b as (select doc_id, p, regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g') as solid from a),
    n as (select *, row_number() over (partition by doc_id order by p) as pos from b where solid <> ''),
    k as (select x.doc_id, x.pos, x.p as p1, y.p as p2, z.p as p3, md5(x.solid || chr(10) || y.solid || chr(10) || z.solid) as h
          from n x join n y on y.doc_id = x.doc_id and y.pos = x.pos + 1 join n z on z.doc_id = x.doc_id and z.pos = x.pos + 2),
    o as (select *, row_number() over (partition by h order by doc_id, pos) as seen from k),
    g as (select doc_id, p, row_number() over (partition by md5(solid) order by doc_id, pos) as seen from n where len(regexp_extract_all(solid, '[^{SPACE[1:]}+')) >= {LONG_LINE}),
    c as (select distinct doc_id, unnest([p1, p2, p3]) as p from o where seen > 1 union select doc_id, p from g where seen > 1),
    s as (select a.doc_id, count(*) as n_lines, count(c.p) as n_removed, string_agg(line, chr(10) order by a.p) filter (where c.p is null) as kept
          from a left join c on c.doc_id = a.doc_id and c.p = a.p group by 1)
    select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from documents d left join s using (doc_id)"""


def _license_scan() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    reach = reach_of(TEMPLATES)
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    templates = ", ".join(
        f"('{label}', {sorted(set(text.split()))!r}, {math.ceil(CONTAINMENT * len(set(text.split())))})" for label, text in sorted(TEMPLATES.items())
    )
    phrases = " union all ".join(
        f"select doc_id, i - 1 as place, '{label}' as label from p where "
        + " and ".join(f"ws[i + {j}] = '{w}'" for j, w in enumerate(phrase.split()))
        for phrase, label in PHRASES.items()
    )
    return f"""with t as (select doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') as text from documents),
    w as (select doc_id, regexp_extract_all(text, '{word}') as ws from t),
    p as (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from w),
    b as ({phrases}),
    base as (select doc_id, count(*) as n_base, min(place) as first_word, max(place) as last_word, list_sort(list(distinct label)) as hit from b group by 1),
    l as (select doc_id, list_distinct(list_slice(ws, k * {reach} + 1, k * {reach} + {2 * reach})) as words
          from (select doc_id, ws, unnest(range(0, greatest(cast(ceil(len(ws) / {reach}.0) as bigint) - 1, 1))) as k from w)),
    m as (select label, tokens, needed from (values {templates}) v(label, tokens, needed)),
    n as (select doc_id, label, len(list_intersect(words, tokens)) * 1.0 / len(tokens) as containment from l join m on len(words) >= needed and len(list_intersect(words, tokens)) >= needed),
    found as (select doc_id, list(distinct label) as more, max(containment) as best from n group by 1)
    select w.doc_id, len(ws) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(array_to_string(hit, ','), '') as base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(hit, []), coalesce(more, [])))), ',') as labels,
    case when hit is not null then 1.0 else coalesce(best, 0.0) end as score from w left join base using (doc_id) left join found using (doc_id)"""


def _told(column: str, value: str | None = None) -> str:
    value = value or f"cast({column} as varchar)"
    return f"coalesce(cast(strlen({value}) as varchar) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join([*map(_told, ('doc_id', 'source', 'lang', 'n_chars')), _told('text', text)])})"


#: DuckDB has no CRC-32; this is its table-free form, a step for each bit of the decimal digits.
_CRC = """crc as (select v, cast(4294967295 as ubigint) as c, 0 as i from (select distinct cast(doc_id as varchar) as v from documents where doc_id is not null)
    union all select v, list_reduce(list_prepend(xor(c, cast(ascii(v[i + 1]) as ubigint)), [cast(x as ubigint) for x in range(8)]), lambda a, _: case when a & 1 = 1 then xor(a >> 1, cast(3988292384 as ubigint)) else a >> 1 end), i + 1
    from crc where i < strlen(v)),
    checked as (select v, xor(c, cast(4294967295 as ubigint)) as crc from crc where i = strlen(v))"""

_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

MERKLE_MANIFEST = f"""with recursive {_CRC},
    leaves as materialized (select row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n, * from
        (select doc_id, source, {_leaf('text')} as leaf, case when crc % 5 = 0 then {_leaf(_LOWER)} else {_leaf('text')} end as altered from documents left join checked on v = cast(doc_id as varchar))),
    nodes as (select source, 0 as level, pos, n, leaf as digest from leaves
        union all select source, level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' order by pos)) from nodes where n > 1 group by source, level, pos // 16),
    subroots as (select source, digest as subroot, row_number() over (order by source nulls first) - 1 as place, count(*) over () as n from nodes where n = 1),
    sources as (select 0 as level, place as pos, n, subroot as digest from subroots
        union all select level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' order by pos)) from sources where n > 1 group by level, pos // 16),
    top as (select digest as root from sources where n = 1),
    runs as (select source, level, pos, digest from nodes where n > 1),
    every as materialized (select l.*, subroot, place, row_number() over () as row from leaves l join subroots s on l.source is not distinct from s.source),
    beside as (select row, level, r.pos as spot, digest, r.pos = e.pos // cast(16 ** level as bigint) as own from every e join runs r on r.source is not distinct from e.source and r.pos // 16 = e.pos // cast(16 ** (level + 1) as bigint)
        union all select row, 100 + level, s.pos, digest, s.pos = place // cast(16 ** level as bigint) from every join sources s on s.n > 1 and s.pos // 16 = place // cast(16 ** (level + 1) as bigint)),
    sides as (select row, dense_rank() over (partition by row order by level) - 1 as step, before, after from (select row, level, string_agg(digest, '' order by spot) filter (where not own and spot < mine) as before,
        string_agg(digest, '' order by spot) filter (where not own and spot > mine) as after from (select *, max(spot) filter (where own) over (partition by row, level) as mine from beside) group by row, level)),
    climb as (select row, 0 as step, altered as digest from every
        union all select c.row, c.step + 1, sha256(coalesce(before, '') || digest || coalesce(after, '')) from climb c join sides s on s.row = c.row and s.step = c.step),
    shown as (select row, sha256(string_agg(coalesce(before, '') || coalesce(after, ''), '' order by step)) as proof from sides group by row),
    ended as (select row, arg_max(digest, step) as folded_root from climb group by row)
    select doc_id, leaf, subroot, root, coalesce(proof, sha256('')) as proof_sha256, folded_root, folded_root = root as verified
    from every join ended using (row) left join shown using (row), top"""


ORACLES = {"op1_line_dedup": LINE_DEDUP, "op6_license_scan": _license_scan(), "op10_substring_dedup": SUBSTRING_DEDUP, "op12_merkle_manifest": MERKLE_MANIFEST}
