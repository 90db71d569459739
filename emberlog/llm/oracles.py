"""DuckDB SQL for the queries that SQL can express, written independently of the operators."""

_SPACED = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"list_filter(regexp_split_to_array({_LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_REACH = """reach as (
  select {id} as a, {id} as b from {nodes} union select r.a, l.y from reach r join links l on r.b = l.x
), parts as (select a as {id}, min(b) as component_id from reach group by a)"""

JACCARD = f"""with recursive d as (select doc_id, {_SPACED.format(text=_LOWERED)} as w from documents),
sets as (
  select distinct doc_id, list_slice(w, i, i + least(3, len(w)) - 1) as g
  from d, unnest(range(1, greatest(2, len(w) - 1))) t(i) where len(w) > 0
), sizes as (select doc_id, count(*) as n from sets group by doc_id),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from sets a join sets b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
pairs as (select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 90 * (p.n + q.n - c)),
links as (select x, y from pairs union all select y, x from pairs),
{_REACH.format(id="doc_id", nodes="documents")}
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id from parts left join sizes using (doc_id)"""

_ROLE = "coalesce(role, '')"
CHAT = rf"""with t as (
  select conv_id, turn, {_ROLE} as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized as (
  select *, length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g')) + case role when 'system' then 15 when 'user' then 13
    when 'assistant' then 7 else 21 + length(role) + length(regexp_replace(role, '[^\\<\[]', '', 'g')) end as chars,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as k, count(*) over (partition by conv_id) as n
  from t
), summed as (select *, sum(chars) over (partition by conv_id order by k) as upto from sized)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
  (sum(upto) filter (role = 'assistant' or k = n))::bigint as formatted_chars
from summed group by conv_id"""

SUBSTRINGS = f"""with d as (select doc_id, {_SPACED.format(text="coalesce(text, '')")} as w from documents),
win as (select doc_id, i, list_slice(w, i, i + 12) as g from d, unnest(range(1, greatest(1, len(w) - 11))) t(i)),
least_id as (select g, min(doc_id) as m from win group by g),
gone as (select distinct doc_id, i + k as p from win join least_id using (g), unnest(range(13)) u(k) where m < doc_id),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from d),
sums as (
  select doc_id, count(gone.p) as n_removed, string_agg(word, ' ' order by p) filter (gone.p is null) as kept
  from words left join gone using (doc_id, p) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join sums using (doc_id)"""

CONTAMINATION = f"""with d as (select doc_id, {_ALNUM} as w from documents),
b as (select item_id, {_ALNUM} as w from benchmark where item_id is not null),
win as (select distinct item_id, least(13, len(w)) as n, list_slice(w, i, i + least(13, len(w)) - 1) as g from b, unnest(range(1, len(w) - least(13, len(w)) + 2)) t(i) where len(w) > 0),
dw as (select doc_id, n, i, list_slice(w, i, i + n - 1) as g from d, (select distinct n from win), unnest(range(1, greatest(1, len(w) - n + 2))) t(i)),
found as (select doc_id, i, n, item_id from dw join win using (n, g)),
hit as (select doc_id, count(distinct i + k) as n_hit from found, unnest(range(n)) u(k) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(x, ',' order by x) as names from (select distinct doc_id, item_id::varchar as x from found) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(w), false) as contaminated
from d left join hit using (doc_id) left join items using (doc_id)"""

VECTORS = f"""with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (select a.vec_id as x, b.vec_id as y from v a join v b on a.vec_id < b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.9),
links as (select x, y from pairs union all select y, x from pairs),
{_REACH.format(id="vec_id", nodes="embeddings")},
counts as (select x as vec_id, count(*) as n from links group by x)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept from parts left join counts using (vec_id)"""

def _votes() -> str:
    """Votes in the order of the rules, written out once more."""
    rules = [
        ("n_words >= 50", "n_words < 20"),
        ("word_chars >= 3 * n_words and word_chars <= 9 * n_words", "word_chars < 2 * n_words or word_chars > 12 * n_words"),
        ("n_symbols * 50 <= n_words", "n_symbols * 10 > n_words"),
        ("n_dup_lines = 0 and n_lines >= 3", "n_dup_lines * 10 > 3 * n_lines"),
        ("n_repeat_words * 50 <= n_words", "n_repeat_words * 10 > n_words"),
        ("n_capitals * 8 <= n_letters and n_letters > 0", "n_capitals * 3 > n_letters"),
        ("n_letters * 10 >= 9 * word_chars", "n_letters * 10 < 7 * word_chars"),
        ("n_ended * 2 >= n_lines", "n_ended * 10 < n_lines"),
        ("n_shouts = 0", "n_shouts * 20 > n_words"),
        ("n_words >= 20 and n_distinct * 10 >= 3 * n_words", "n_distinct * 10 < n_words"),
    ]
    return ", ".join(f"case when n_words = 0 then 0 when {good} then 1 when {bad} then -1 else 0 end as v{k}" for k, (good, bad) in enumerate(rules))


def _estimate(rules: int = 10, rounds: int = 20) -> str:
    """One table of parameters for each round: p, r0.. (good votes on good documents), f0.. (on bad ones)."""
    numbers = range(rules)
    weight = " + ".join(["ln(p / (1 - p))", *[f"case when v{k} > 0 then ln(r{k} / f{k}) when v{k} < 0 then ln((1 - r{k}) / (1 - f{k})) else 0 end" for k in numbers]])
    tables = ["m0 as (select 0.8::double as p, " + ", ".join(f"0.98::double as r{k}, 0.6::double as f{k}" for k in numbers) + ")"]
    for i in range(rounds):
        share = ", ".join(
            f"(coalesce(sum({w}) filter (v{k} > 0), 0) + {start}) / (coalesce(sum({w}) filter (v{k} <> 0), 0) + 1) as {name}{k}"
            for k in numbers for name, w, start in (("r", "n * g", 0.98), ("f", "n * (1 - g)", 0.6))
        )
        tables.append(f"e{i} as materialized (select *, 1 / (1 + exp(-({weight}))) as g from patterns, m{i})")
        tables.append(f"m{i + 1} as materialized (select (coalesce(sum(n * g), 0) + 0.8) / (coalesce(sum(n), 0) + 1) as p, {share} from e{i})")
    return ",\n".join(tables) + f",\nlast as (select *, 1 / (1 + exp(-({weight}))) as g from voted, m{rounds})"


_SOLID = "translate({text}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')"
QUALITY = rf"""with d as (
  select doc_id, coalesce(text, '') as text, {_SPACED.format(text="coalesce(text, '')")} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: {_SOLID.format(text="x")} <> '') as l from documents
), windows as (select doc_id, i, list_slice(w, i, i + 4) as g from d, unnest(range(1, len(w) - 3)) t(i)),
twice as (select doc_id, g from windows group by all having count(*) > 1),
repeated as (select doc_id, count(distinct i + k) as n from windows join twice using (doc_id, g), unnest(range(5)) u(k) group by doc_id),
figures as (
  select doc_id, len(w)::bigint as n_words, length({_SOLID.format(text="text")})::bigint as word_chars, (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words, len(l) as n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '[.!?][\x22\x27)\x{{201D}}\x{{00BB}}]?[\x20\x09-\x0D]*\z'))) as n_ended,
    length(regexp_replace(text, '\P{{Lu}}', '', 'g')) as n_capitals, length(regexp_replace(text, '\P{{L}}', '', 'g')) as n_letters,
    (length(text) - length(replace(text, '!!', ''))) // 2 as n_shouts, len(list_distinct(w)) as n_distinct
  from d left join repeated using (doc_id)
), voted as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, {_votes()} from figures),
patterns as materialized (select {", ".join(f"v{k}" for k in range(10))}, count(*) as n from voted where not base_failed group by all),
{_estimate()}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and g >= 0.5 as kept, round(g, 6) as quality from last"""

# CRC-32 as a fold over bytes; the letters of the words are one byte or, from U+00C0 to U+00FF, two
_CRC_STEP = "list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, {b})"
VARIANTS = f"""with recursive crc as materialized (select list(v order by b) as t from (select b, {_CRC_STEP.format(b="b")} as v from range(256) r(b)) q),
raw as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as w from documents
), bytes as (
  select w, flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda c: case when unicode(c) < 128 then [unicode(c)] else [195, unicode(c) - 64] end)) as b from raw
), hashed as (select w, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) as h from bytes, crc),
cut as (select case when h % 199 = 0 then w[1:(h % length(w))::int] || w[(h % length(w))::int + 2:] else w end as word from hashed),
words as materialized (select word, count(*) as n from cut where length(word) >= 6 group by word having count(*) >= 5),
holes as materialized (select word, n, i, word[1:i - 1] as l, word[i + 1:] as r from words, unnest(range(1, length(word) + 1)) t(i)),
near as materialized (
  select distinct a.word, b.word as near, b.n from holes a join holes b on a.i = b.i and a.l = b.l and a.r = b.r and a.word <> b.word
  union select distinct a.word, b.word, b.n from holes a join words b on a.l || a.r = b.word
  union select distinct b.word, a.word, a.n from holes a join words b on a.l || a.r = b.word
), ranked as (select word, near, n, count(*) over (partition by word) as n_near, row_number() over (partition by word order by n desc, near) as k from near),
formed as materialized (
  select w.word, w.n, coalesce(r.n_near, 0)::bigint as n_near, case when r.n >= 5 * w.n then r.near end as form, case when r.n >= 5 * w.n then r.n end as form_n
  from words w left join ranked r on r.word = w.word and r.k = 1
), walk as (select word, word as at from formed union select k.word, f.form from walk k join formed f on f.word = k.at where f.form is not null),
ends as (select k.word, k.at as root from walk k join formed f on f.word = k.at where f.form is null)
select word, form, root, n, n_near, form_n from formed join ends using (word)"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard": JACCARD,
    "op2_chat_format": CHAT,
    "op3_substring_dedup": SUBSTRINGS,
    "op6_decontaminate": CONTAMINATION,
    "op8_embedding_dedup": VECTORS,
    "op11_quality_rules": QUALITY,
    "op13_spelling_variants": VARIANTS,
}
