"""SQL for the queries that SQL can express, written from what they are to return."""

from __future__ import annotations

WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

MIX = f"""with sized as (select doc_id, source, len({WORDS.format("coalesce(text, '')")}) size from documents),
named as (select source, cast(sum(size) as bigint) source_size, row_number() over (order by source nulls last) place
 from sized group by source),
weighed as (select *, cast([5, 2, 1][cast((place - 1) % 3 + 1 as int)] as double) weight, 2.0::double * source_size cap,
 1.5::double * sum(source_size) over () budget from named),
levels as (select *, cap / weight ratio, (budget - coalesce(sum(cap) over (order by cap / weight, place
  rows between unbounded preceding and 1 preceding), 0)) / sum(weight) over (order by cap / weight, place
  rows between current row and unbounded following) own_level from weighed),
targets as (select *, least(cap, weight * (select arg_min(own_level, row(ratio, place)) from levels where own_level <= ratio)) target
 from levels),
queued as (select s.doc_id, s.size, t.source_size, t.target, t.place, t.budget, sum(s.size) over (partition by t.place
  order by md5(concat('mix', s.doc_id)), s.doc_id, s.size rows between unbounded preceding and current row) upto
 from sized s join targets t on s.source is not distinct from t.source),
copies as (select doc_id, size, place, budget, upto / target finish from queued where size > 0
 union all select doc_id, size, place, budget, (upto + source_size) / target from queued where size > 0),
spent as (select *, sum(size) over (order by finish, place rows between unbounded preceding and current row) total from copies),
taken as (select doc_id, sum(size) taken from spent where total <= budget group by doc_id)
select q.doc_id, cast(q.size as bigint) size, q.source_size, q.target, cast(coalesce(t.taken, 0) as bigint) taken
 from queued q left join taken t on t.doc_id = q.doc_id"""

_DIGIT = " + ".join(f"cast(substr(bits, i * 5 + {k + 1}, 1) as int) * {16 >> k}" for k in range(5))

ARCHIVES = f"""with payloads as (select page_id, strlen(coalesce(html, '')) payload_bytes,
 cast(cast(unhex(sha1(coalesce(html, ''))) as bit) as varchar) bits from pages),
firsts as (select *, min(page_id) over (partition by bits) first_page from payloads)
select page_id, cast(payload_bytes as bigint) payload_bytes,
 array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + {_DIGIT} as int), 1)), '') payload_digest,
 case when page_id = first_page then 'response' else 'revisit' end record_type,
 case when page_id <> first_page then first_page end refers_to from firsts"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""with recursive words as (select doc_id, {WORDS.format(_LOWER)} w from documents),
sets as materialized (select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
 else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) end s from words),
shingles as (select doc_id, unnest(s) x from sets),
shared as (select a.doc_id a, b.doc_id b, count(*) n from shingles a join shingles b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
links as materialized (select a, b from shared join sets p on p.doc_id = a join sets q on q.doc_id = b
 where 100 * n >= 80 * (len(p.s) + len(q.s) - n)),
both_ways as (select a, b from links union all select b, a from links),
reached as (select doc_id a, doc_id b from documents union select r.a, l.b from reached r join both_ways l on l.a = r.b),
lowest as (select a, min(b) low from reached group by a)
select doc_id, cast(len(s) as bigint) n_shingles, low component_id, doc_id = low kept from sets join lowest on a = doc_id"""


def _kind(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""select doc_id, {order} k, '{kind}' kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'at':
  cast(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) as bigint),
  'n': length(m[i]), 'v': length(v[i])}})) x, {least} least from (select doc_id, regexp_extract_all(text, '{quoted}', 0) m,
  regexp_extract_all(text, '{quoted}', {group}) v, string_split_regex(text, '{quoted}') p from documents where text is not null)"""


# The three base kinds, and the kinds that the scan adds. A run of 24 or more is a run that is long enough.
KINDS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
]

SECRETS = (
    "with found as (" + "\nunion all ".join(_kind(k, *row) for k, row in enumerate(KINDS)) + """),
kept as (select doc_id, k, kind, x.at a, x.at + x.n b from found where x.v >= least),
told as (select doc_id, count(*) filter (where k = 0) n_assign, count(*) filter (where k = 1) n_access,
 count(*) filter (where k = 2) n_hex, string_agg(concat(kind, ':', a, ':', b), ',' order by a, k) filter (where k < 3) base,
 string_agg(concat(kind, ':', a, ':', b), ',' order by a, k) spans from kept group by doc_id)
select d.doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex,
 sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans from documents d left join told t on t.doc_id = d.doc_id"""
)


_PLAIN = "coalesce(cast({0} as varchar), ' ')"
# CRC-32 bit by bit: a byte is mixed in before the first of its eight shifts.
_CRC = """xor(list_reduce(flatten(list_transform(string_split({0}, ''), lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0])),
 lambda a, x: xor(xor(a, cast(x as bigint)) >> 1, case when xor(a, cast(x as bigint)) & 1 = 1 then 3988292384 else 0 end), 4294967295), 4294967295)"""

# Forwards over the rows of all conversations at once: the cheapest way into each state (0 nothing, 1 system, 2 user,
# 3 assistant) with its audit and text. Equal costs at the same row are told apart by the audit so far.
_BREAK = "case when b.t = '' then '' else chr(10) end"
_INSERTS = f"""select conv_id, i, o.s state, min({{'c': b.c + 2 * length(o.letters), 'a': b.a || o.letters,
  't': b.t || case when o.letters = '' then '' else {_BREAK} || o.made end}}) b
 from (select *, unnest(case state when 2 then [{{'letters': '', 's': 2, 'made': ''}}, {{'letters': 'I', 's': 3, 'made': 'assistant:'}}]
  else [{{'letters': '', 's': state, 'made': ''}}, {{'letters': 'I', 's': 2, 'made': 'user:'}},
   {{'letters': 'II', 's': 3, 'made': 'user:' || chr(10) || 'assistant:'}}] end) o from FROM_HERE) group by conv_id, i, o.s"""
_STEP = f"""(select conv_id, i, o.s state, min({{'c': b.c + o.c, 'a': b.a || o.letter,
  't': b.t || case when o.letter = 'D' then '' else {_BREAK} || o.line end}}) b
 from (select p.conv_id, m.n i, p.b, unnest(list_filter([{{'letter': 'D', 'c': 3, 's': p.state, 'line': ''}},
   {{'letter': 'K', 'c': m.more, 's': case when left(m.r, 1) = 's' and p.state = 0 then 1 when left(m.r, 1) = 'u' and p.state <> 2 then 2
     when left(m.r, 1) = 'a' and p.state = 2 then 3 end, 'line': m.r || ':' || m.t}},
   {{'letter': 'R', 'c': 2 + m.more, 's': case when p.state = 2 then 3 else 2 end,
     'line': case when p.state = 2 then 'assistant:' else 'user:' end || m.t}}],
   lambda x: x.s is not null and (x.letter = 'D' or m.more < 2))) o
  from paths p join (select *, case fault when '' then 0 when 'truncated' then 1 else 2 end more from marked) m
   on m.conv_id = p.conv_id and m.n = p.i + 1) group by conv_id, i, o.s)"""

REPAIR = f"""with recursive plain as (select conv_id, turn, {_PLAIN.format("role")} r, {_PLAIN.format("text")} t,
 {_CRC.format(f"{_PLAIN.format('conv_id')} || ':' || {_PLAIN.format('turn')}")} % 20 kind from conversations),
damaged as (select conv_id, turn, case when kind = 4 then 'user' else r end r, case kind when 1 then ''
 when 2 then translate(t, '.!?', '') else t end t, unnest(case when kind = 3 then [0, 1] else [0] end) as copy_no from plain where kind <> 0),
numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, r, left(t, 100), md5(t), copy_no) n from damaged),
marked as materialized (select *, case when not regexp_matches(t, '[^\\x20\\x09-\\x0D]') then 'blank'
 when row_number() over (partition by conv_id, r, t order by n) > 1 then 'duplicate'
 when not regexp_matches(t, '[.!?][\\x20\\x09-\\x0D]*\\z') then 'truncated' else '' end fault,
 lead(left(r, 1)) over (partition by conv_id order by n) follower from numbered),
told as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where fault = 'blank') blank,
 count(*) filter (where fault = 'duplicate') duplicate, count(*) filter (where fault = 'truncated') truncated,
 count(*) filter (where left(r, 1) || follower not in ('su', 'ua', 'au')) illegal, count(*) n_rows from marked group by conv_id),
begun as (select conv_id, cast(0 as bigint) i, 0 state, {{'c': 0, 'a': '', 't': ''}} b from told),
paths as (select conv_id, i, state, b from ({_INSERTS.replace("FROM_HERE", "begun")})
 union all select conv_id, i, state, b from ({_INSERTS.replace("FROM_HERE", _STEP)})),
ended as (select p.conv_id, min(b) b from paths p join told on told.conv_id = p.conv_id and p.i = n_rows
 where state in (0, 3) group by p.conv_id)
select c.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
 coalesce(illegal, 0) illegal, cast(coalesce(b.c, 0) as bigint) "cost", coalesce(b.a, '') audit, sha256(coalesce(b.t, '')) repaired_sha256
from (select distinct conv_id from conversations) c left join told on told.conv_id = c.conv_id left join ended on ended.conv_id = c.conv_id"""

NEGATIVES = """with whole as materialized (select cast(vec_id as bigint) id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) l,
 list_transform(embedding, lambda x: floor(256 * cast(x as double))) v from embeddings where vec_id is not null and label is not null
 and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as materialized (select a.id anchor, r.id other, a.l = r.l same, cast(list_dot_product(a.v, r.v) as bigint) s
 from whole a join whole r on true where a.id % 50 = 0),
near as (select anchor, other, s from scored where same and other <> anchor
 qualify row_number() over (partition by anchor order by s desc, other) <= 5),
ranked as (select p.anchor anchor_id, p.other positive_id,
 cast(row_number() over (partition by p.anchor, p.other order by n.s desc, n.other) as int) "rank",
 n.other negative_id, p.s positive_score, n.s negative_score from near p join scored n
 on n.anchor = p.anchor and not n.same and 50 * p.s <= 100 * n.s and 100 * n.s <= 95 * p.s)
select * from ranked where "rank" <= 3"""


# Shares in which the rules vote bad, and those in which they vote good.
QUALITY_VOTES = [
    ("n_symbols > 0.3 * n_words", "n_symbols < 0.02 * n_words"),
    ("n_symbol_runs > 0.2 * n_words", "n_symbol_runs < 0.02 * n_words"),
    ("n_letter_runs < 0.7 * n_words", "n_letter_runs > 0.9 * n_words"),
    ("n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0"),
    ("n_repeat_words > 0.2 * n_words", "n_repeat_words < 0.02 * n_words"),
    ("word_chars < 3 * n_words or word_chars > 10 * n_words", "word_chars > 4 * n_words and word_chars < 6.5 * n_words"),
    ("n_caps > 0.3 * n_words", "n_caps < 0.05 * n_words"),
    ("n_marks > 0.3 * n_words", "n_marks < 0.05 * n_words"),
    ("n_varied < 0.15 * n_words", "n_varied > 0.35 * n_words"),
    ("n_words >= 50 and n_stops < 0.01 * n_words", "n_stops > 0.05 * n_words"),
]


def _round(k: int) -> str:
    """One round of expectation-maximisation: what each vote weighs, then how likely good each pattern is."""
    return f"""start{k} as materialized (select ln((1 + sum(n * good)) / (1 + sum(n * (1 - good)))) odds from good{k - 1}),
weights{k} as materialized (select place, vote, ln((g + b_g) / (all_g + 100) / ((b + b_b) / (all_b + 100))) weight from (
 select place, vote, b_g, b_b, g, b, sum(g) over (partition by place) all_g, sum(b) over (partition by place) all_b from (
  select f.place, f.vote, any_value(b_g) b_g, any_value(b_b) b_b, coalesce(sum(n * good), 0) g, coalesce(sum(n * (1 - good)), 0) b
  from belief f left join cast_votes c on c.place = f.place and c.vote = f.vote left join good{k - 1} p on p.pattern = c.pattern group by f.place, f.vote))),
good{k} as materialized (select p.pattern, any_value(p.n) n, 1 / (1 + exp(-(any_value(odds) + sum(weight)))) good
 from good{k - 1} p cross join start{k} join cast_votes c on c.pattern = p.pattern join weights{k} w on w.place = c.place and w.vote = c.vote group by p.pattern)"""


_VOTES = " || ".join(f"case when {bad} then 'b' when {good} then 'g' else '-' end" for bad, good in QUALITY_VOTES)
_ROUNDS = 30

QUALITY = f"""with texts as materialized (select row_number() over () r, doc_id, coalesce(text, '') text from documents),
split as materialized (select r, {WORDS.format("text")} w,
 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) lines from texts),
tokens as (select r, unnest(w) word, unnest(range(len(w))) spot from split),
told as (select r, sum(length(word)) word_chars, count(distinct (spot // 1000, word)) n_varied from tokens group by r),
followed as (select r, spot, [word, lead(word, 1) over o, lead(word, 2) over o, lead(word, 3) over o, lead(word, 4) over o] five
 from tokens window o as (partition by r order by spot)),
again as (select r, spot from followed where five[5] is not null qualify count(*) over (partition by r, five) > 1),
stretches as (select r, least(5, spot - coalesce(lag(spot) over (partition by r order by spot), spot - 5)) more from again),
repeated as (select r, sum(more) n_repeat_words from stretches group by r),
measured as materialized (select t.r, t.doc_id, len(w) n_words, coalesce(word_chars, 0) word_chars,
 len(regexp_extract_all(text, '[#*$%&|<>]')) n_symbols, len(lines) n_lines, len(lines) - len(list_distinct(lines)) n_dup_lines,
 coalesce(n_repeat_words, 0) n_repeat_words, coalesce(n_varied, 0) n_varied, len(regexp_extract_all(text, '[A-Z]{{2,}}')) n_caps,
 len(regexp_extract_all(text, '[#*$%&|<>]+')) n_symbol_runs, len(regexp_extract_all(text, '\\p{{L}}+')) n_letter_runs,
 len(regexp_extract_all(text, '[!?]')) n_marks, len(regexp_extract_all(text, '\\p{{Ll}}[.,;:?](?:[\\x20\\n]|\\z)')) n_stops
 from texts t join split s on s.r = t.r left join told on told.r = t.r left join repeated p on p.r = t.r),
voted as materialized (select *, {_VOTES} pattern from measured),
good0 as materialized (select pattern, count(*) n, (1 + len(replace(replace(pattern, 'b', ''), '-', ''))) /
 (2 + len(replace(replace(pattern, 'b', ''), '-', '')) + 3 * len(replace(replace(pattern, 'g', ''), '-', ''))) good from voted group by pattern),
cast_votes as materialized (select pattern, place, substr(pattern, place, 1) vote from good0, range(1, 11) x(place)),
belief as materialized (select place, vote, case vote when 'g' then 75 when 'b' then 2.5::double else 22.5::double end b_g,
 case vote when 'g' then 50 when 'b' then 30 else 20 end b_b from range(1, 11) x(place), (values ('g'), ('b'), ('-')) y(vote)),
{(","+chr(10)).join(_round(k) for k in range(1, _ROUNDS + 1))}
select doc_id, cast(n_words as bigint) n_words, cast(word_chars as bigint) word_chars, cast(n_symbols as bigint) n_symbols,
 cast(n_dup_lines as bigint) n_dup_lines, cast(n_repeat_words as bigint) n_repeat_words,
 n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed,
 not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and good >= 0.5 kept, round(good, 6) posterior from voted v join good{_ROUNDS} p on p.pattern = v.pattern"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mix_sources": MIX,
        "op4_warc_chunks": ARCHIVES,
        "op6_circulant_minhash": NEAR_DUPLICATES,
        "op7_secret_scan": SECRETS,
        "op8_quality_rules": QUALITY,
        "op12_conversation_repair": REPAIR,
        "op13_hyperplane_tree": NEGATIVES,
    }
