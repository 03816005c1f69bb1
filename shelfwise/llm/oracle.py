"""The same results in DuckDB SQL, where SQL can express the operator.

Missing are the trained classifiers (1, 3), the heap (5), the bootstrapped patterns (9) and the
fingerprints (12, for want of the hash), which tests hold against plain computations or held-out
labels.
"""

from __future__ import annotations

from shelfwise.llm import decontamination as D
from shelfwise.llm import mixing as M
from shelfwise.llm import quality as Q
from shelfwise.llm import secrets_scan as S

_SEPARATORS = r"[\x20\x09-\x0D]+"


def _words(text: str, pattern: str = _SEPARATORS) -> str:
    return f"list_filter(string_split_regex({text}, '{pattern}'), lambda x: x <> '')"


_TEXTS = "select row_number() over () rid, *, coalesce(text, '') t from documents"

OP2 = f"""
with d as ({_TEXTS}),
w as (select *, {_words('t')} ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) ls
      from d),
win as (select rid, i, ws[i] || chr(1) || ws[i + 1] || chr(1) || ws[i + 2] g
        from (select rid, ws, unnest(range(1, len(ws) - 1)) i from w)),
again as (select rid, i from win qualify count(*) over (partition by rid, g) > 1),
covered as (select rid, count(distinct p) n from
            (select rid, unnest([i, i + 1, i + 2]) p from again) group by rid),
base as (select w.rid, doc_id, source, len(ws)::bigint n_words,
                coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint word_chars,
                (length(t) - length(translate(t, '{Q.SYMBOLS}', '')))::bigint n_symbols,
                (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines,
                coalesce(n, 0)::bigint n_repeat_words
         from w left join covered c on w.rid = c.rid),
judged as (select *, n_words < {Q.MIN_WORDS}
                     or 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words base_failed
           from base),
failed as (select source, unnest([
             {{'rule': 'short', 'bad': n_words < {Q.MIN_WORDS}}},
             {{'rule': 'repeats', 'bad': 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words}},
             {{'rule': 'symbols', 'bad': 100 * n_symbols > {Q.MAX_SYMBOL_PERCENT} * n_words}},
             {{'rule': 'lines', 'bad': 100 * n_dup_lines > {Q.MAX_DUP_LINE_PERCENT} * n_words}}]) x
           from judged),
hosts as (select source, x.rule r, count(*)::double n, count(*) filter (x.bad)::double f
          from failed group by all),
means as (select r, sum(f) / sum(n) m from hosts group by r),
spread as (select r, m, sum(n * (f / n - m) * (f / n - m)) observed,
                  (count(*) - 1) * m * (1 - m) chance,
                  m * (1 - m) * (sum(n) - sum(n * n) / sum(n)) whole
           from hosts join means using (r) group by r, m),
rho as (select r, m, case when whole > chance
                          then least((observed - chance) / (whole - chance), 1) else 0 end rho
        from spread),
prior as (select r, m, case when rho > 0 then least(1 / rho - 1, {Q.MAX_PRIOR}) else {Q.MAX_PRIOR} end k
          from rho),
shrunk as (select source, m, (f + m * k) / (n + k) p, n + k + 1 weight from hosts join prior using (r)),
sure as (select source, m, p - {Q.CAUTION} * sqrt(p * (1 - p) / weight) rate from shrunk),
verdict as (select source, bool_or(rate > {Q.MAX_HOST_RATE} and rate > {Q.MAX_HOST_RATIO} * m) bad
            from sure group by source)
select j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not bad kept
from judged j join verdict h on j.source is not distinct from h.source
"""

_WEIGHT = " ".join(f"when {i} then {w}" for i, w in enumerate(M.WEIGHTS))
OP4 = f"""
with d as ({_TEXTS}),
sized as (select rid, doc_id, source, len({_words('t')})::bigint size,
                 ('0x' || substr(md5('{M.SEED}:' || coalesce(doc_id::varchar, '') || ':' || md5(t)),
                                 1, 15))::bigint key from d),
sources as (select source, sum(size)::bigint s,
                   case (row_number() over (order by source nulls last) - 1) % {len(M.WEIGHTS)}
                   {_WEIGHT} end w from sized group by source),
ranked as (select *, {M.MAX_EPOCHS} * s cap, ({M.MAX_EPOCHS} * s)::double / w lvl,
                  row_number() over (order by source nulls last) rnk from sources),
levels as (select *, ((sum(s) over ())::double * {M.SHARE_PERCENT} / 100
                      - coalesce(sum(cap) over (order by lvl, rnk rows between unbounded preceding
                                                and 1 preceding), 0)::double)
                     / (sum(w) over (order by lvl, rnk rows between current row
                                     and unbounded following))::double reached from ranked),
level as (select arg_min(reached, struct_pack(a := lvl, b := rnk)) filter (reached <= lvl) x
          from levels),
targets as (select source, s, case when lvl < x then cap::double
                               else least(x * w, cap::double) end target from levels, level),
placed as (select z.*, s, target, floor(target + 0.5)::bigint budget,
                  coalesce(sum(size) over (partition by z.source order by key, size, doc_id
                           rows between unbounded preceding and 1 preceding), 0)::bigint before
           from sized z join targets g on z.source is not distinct from g.source)
select doc_id, size, s source_size, target,
       case when s = 0 then 0 else
       (budget // s) * size + greatest(0, least(size, budget - (budget // s) * s - before)) end
       ::bigint taken from placed
"""

OP6 = f"""
with d as ({_TEXTS}),
w as (select rid, doc_id, {_words('t')} ws from d),
win as (select rid, doc_id, i, array_to_string(ws[i:i + 12], chr(1)) g
        from (select *, unnest(range(1, len(ws) - 11)) i from w)),
gone as (select rid, i from win qualify min(doc_id) over (partition by g) < doc_id),
covered as (select distinct rid, p from (select rid, unnest(range(i, i + 13)) p from gone)),
kept as (select rid, string_agg(x, ' ' order by p) k from
         (select rid, unnest(ws) x, unnest(range(1, len(ws) + 1)) p from w) a
         where not exists (from covered c where c.rid = a.rid and c.p = a.p) group by rid),
lost as (select rid, count(*) n from covered group by rid)
select doc_id, len(ws)::bigint n_words, coalesce(n, 0)::bigint n_removed,
       sha256(coalesce(k, '')) kept_sha256
from w left join kept k on w.rid = k.rid left join lost l on w.rid = l.rid
"""


def _seed(words: str, at: str) -> str:
    """The masks' seeds at a 0-based position as a list of texts."""
    return "[" + ", ".join(
        f"'{k}'" + "".join(f" || '|' || {words}[{at} + {i + 1}]" for i in mask)
        for k, mask in enumerate(D.MASKS)) + "]"


OP7 = f"""
with d as (select row_number() over () rid, doc_id, text,
                  {_words("lower(coalesce(text, ''))", '[^\\p{L}\\p{N}]+')} ws from documents),
b as (select item_id, {_words("lower(coalesce(text, ''))", '[^\\p{L}\\p{N}]+')} bs from benchmark),
ds as (select rid, p, unnest({_seed('ws', 'p')}) seed from
       (select rid, ws, unnest(range(0, len(ws) - {D.SPAN} + 1, {D.STRIDE})) p from d)),
bs as (select item_id, j, unnest({_seed('bs', 'j')}) seed from
       (select item_id, bs, unnest(range(0, len(bs) - {D.SPAN} + 1)) j from b
        where len(bs) >= {D.WINDOW})),
starts as (select distinct rid, item_id, p - s st, j - s t0
           from ds join bs using (seed), range(0, {D.WINDOW - D.SPAN + 1}) r(s)
           where p >= s and j >= s),
over as (select doc_id, text, item_id, st, list_sum(list_transform(range(1, {D.WINDOW + 1}),
                lambda k: (ws[st + k] = bs[t0 + k])::int)) n
         from starts join d using (rid) join b using (item_id)
         where st + {D.WINDOW} <= len(ws) and t0 + {D.WINDOW} <= len(bs))
select doc_id, item_id, min(st)::bigint doc_word, max(n)::bigint equal_words
from over where n >= {D.MIN_EQUAL} group by doc_id, text, item_id
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(rule: S.Rule, rank: int) -> str:
    p = _quoted(rule.pattern)
    return f"""
select rid, '{rule.kind}' kind, {rank} rnk, length(g) part,
       coalesce(list_sum(list_transform(gaps[1:k], lambda x: length(x))), 0)::bigint
       + coalesce(list_sum(list_transform(ms[1:k - 1], lambda x: length(x))), 0)::bigint s, length(m) n
from (select rid, gaps, ms, unnest(ms) m, unnest(gs) g, unnest(range(1, len(ms) + 1)) k from
      (select rid, string_split_regex(t, {p}) gaps, regexp_extract_all(t, {p}, 0) ms,
              regexp_extract_all(t, {p}, {rule.group}) gs from d))
where length(g) >= {rule.min_length}"""


_SPAN = "kind || ':' || s::varchar || ':' || (s + n)::varchar"
OP8 = f"""
with d as ({_TEXTS}),
f as ({' union all '.join(_matches(r, k) for k, r in enumerate(S.RULES))})
select doc_id, count(*) filter (kind = 'assign') n_assign,
       count(*) filter (kind = 'access') n_access, count(*) filter (kind = 'hex') n_hex,
       sha256(coalesce(string_agg({_SPAN}, ',' order by s, rnk) filter (rnk < 3), '')) base_sha256,
       coalesce(string_agg({_SPAN}, ',' order by s, rnk), '') spans
from d left join f on d.rid = f.rid group by d.rid, doc_id
"""

OP10 = f"""
with recursive d as (select row_number() over () rid, doc_id,
         {_words("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                 "'abcdefghijklmnopqrstuvwxyz')")} ws from documents),
g as (select distinct rid, array_to_string(ws[i:i + 4], chr(1)) g
      from (select rid, ws, unnest(range(1, greatest(len(ws) - 3, 2))) i from d where len(ws) > 0)),
n as (select rid, count(*) n from g group by rid),
pairs as (select a.rid x, b.rid y, count(*) c from g a join g b on a.g = b.g and a.rid <> b.rid
          group by all),
links as (select x, y from pairs join n a on x = a.rid join n b on y = b.rid
          where 100 * c >= 80 * (a.n + b.n - c)),
reach as (select rid x, rid y from d union select r.x, l.y from reach r join links l on r.y = l.x)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, m.component_id
from d left join n on d.rid = n.rid
join (select x, min(doc_id) component_id from reach join d on y = rid group by x) m on d.rid = m.x
"""


def _assigned(entries: str) -> str:
    """Nearest entry of every part: vec, p, e, dist."""
    return f"""
(select vec, p, arg_min(e, struct_pack(d := d, e := e)) e, min(d) dist from
 (select v.vec, v.p, b.e, sum((v.x - b.x) * (v.x - b.x))::hugeint d
  from dims v join {entries} b on v.p = b.p and v.w = b.w group by all) group by vec, p)"""


def _moved(entries: str) -> str:
    """Entries after a round: means rounded down, unused ones as they were."""
    return f"""
(select b.p, b.e, b.w, coalesce(m.x, b.x) x from {entries} b left join
 (select a.p, a.e, v.w, (sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) x
  from {_assigned(entries)} a join dims v on a.vec = v.vec and a.p = v.p group by all) m
 on b.p = m.p and b.e = m.e and b.w = m.w)"""


OP11 = f"""
with kept as (select row_number() over () vec, * from embeddings
              where embedding is not null and len(list_filter(
                  embedding, lambda x: x is null or not isfinite(x))) = 0),
sized as (select max(len(embedding)) // 16 width from kept),
dims as materialized
 (select vec, i // width p, i % width w, floor(256 * x::double)::hugeint x from
  (select vec, width, unnest(embedding) x, unnest(range(len(embedding))) i from kept, sized)),
b0 as materialized
 (select p, e, w, x from dims join
  (select vec, row_number() over (order by vec_id) - 1 e from kept) using (vec) where e < 64),
b1 as materialized (select * from {_moved('b0')}),
b2 as materialized (select * from {_moved('b1')}),
coded as (select vec, string_agg(printf('%02x', e::int), '' order by p) code,
                 sum(dist)::bigint error from {_assigned('b2')} group by vec),
hashed as (select sha256(string_agg(x::varchar, ',' order by p, e, w)) h from b2)
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error,
       h codebooks_sha256
from kept join coded using (vec), hashed
"""

# CRC-32 of a text, a byte after the other, each by way of a table of 256.
_CRC_TABLE = ("list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), "
              "lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))")


def _word_runs(table: str, key: str) -> str:
    lower = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz')")
    return f"""
(select {key}, len(ws) n_words, unnest(list_concat(ws, list_transform(
        range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) g from
 (select {key}, {_words(lower, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")} ws from {table}))"""


OP13 = f"""
with d as (select row_number() over () rid, * from documents),
crc as (select {_CRC_TABLE} tab),
dg as materialized {_word_runs('d', 'rid')},
bg as materialized {_word_runs('benchmark', 'item_id')},
grams as (select distinct g from (select g from dg union all select g from bg)),
hashed as materialized
 (select g, xor(list_reduce(list_concat([4294967295], list_transform(range(len(hex(g)) // 2),
        lambda i: ('0x' || substr(hex(g), 2 * i + 1, 2))::bigint)),
        lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1])), 4294967295) % 10000 b
  from grams, crc),
s as (select b, count(*) n from dg join hashed using (g) group by b),
t as (select b, count(*) n from bg join hashed using (g) group by b),
sums as (select (select count(*) from dg) s, (select count(*) from bg) t),
gain as (select b, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (sums.s + 10000)::double
                / ((coalesce(s.n, 0) + 1)::double * (sums.t + 10000)::double)))::bigint x
         from (select unnest(range(10000)) b) left join s using (b) left join t using (b), sums),
weighed as (select rid, any_value(n_words) n_words, count(*) n, floor(sum(x) / count(*))::bigint w
            from dg join hashed using (g) join gain using (b) group by rid),
scored as (select rid, doc_id, coalesce(n_words, 0) n_words, coalesce(n, 0)::bigint n_features,
                  coalesce(w, 0) weight, coalesce(w, 0) + floor(-1000 * ln(-ln(
                    (('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint
                     + 0.5::double) / 4294967296)))::bigint score
           from d left join weighed using (rid)),
best as (select rid, row_number() over (order by score desc, doc_id, n_features) rank,
                count(*) over () n from scored where n_words >= 20)
select doc_id, n_features, weight, score, case when rank <= 25 * n // 100 then rank end::bigint rank
from scored left join best using (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_quality": OP2, "op4_mixing": OP4, "op6_substrings": OP6,
            "op7_decontamination": OP7, "op8_secrets": OP8, "op10_jaccard": OP10,
            "op11_vector_codes": OP11, "op13_resampling": OP13}
