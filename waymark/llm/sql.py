"""DuckDB statements for the queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op10_minhash_neardup"] = r"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
    from documents
), g as (
    select doc_id, list_distinct([list_aggregate(words[i:i + 4], 'string_agg', ' ')
        for i in range(1, greatest(2, len(words) - 3)) if len(words) > 0]) as grams
    from w
), u as (select doc_id, unnest(grams) as gram from g),
pair as (
    select a.doc_id as x, b.doc_id as y, count(*) as common
    from u a join u b on a.gram = b.gram and a.doc_id < b.doc_id group by 1, 2
), link as (
    select x, y from pair join g a on a.doc_id = x join g b on b.doc_id = y
    where 100 * common >= 85 * (len(a.grams) + len(b.grams) - common)
), both_ways as (select x, y from link union select y, x from link),
reach(doc_id, seen) as (
    select doc_id, doc_id from g
    union
    select r.doc_id, l.y from reach r join both_ways l on l.x = r.seen
), least as (select doc_id, min(seen) as component_id from reach group by 1)
select g.doc_id, cast(len(grams) as bigint) as n_shingles, component_id, g.doc_id = component_id as kept
from g join least using (doc_id)
"""

SQL["op9_source_mixing"] = r"""
with sized as (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
    from documents
), sums as (select source, cast(sum(size) as hugeint) as s from sized group by 1),
weighed as (
    select source, s, [3, 1, 2][(row_number() over (order by source is null, source) - 1) % 3 + 1] as w from sums
), ranked as (select *, row_number() over (order by 4.0 * s / w, source) as i from weighed),
prefix as (
    select i, source, s, w, coalesce(sum(4 * s) over (order by i rows between unbounded preceding and 1 preceding), 0) as used,
        sum(w) over (order by i rows between current row and unbounded following) as open_w, sum(s) over () as total
    from ranked
), cut as (
    select 3 * total - used as n, open_w, i as first_open from prefix
    where not (4 * s * open_w < (3 * total - used) * w) order by i limit 1
), goal as (
    select source, cast(s as bigint) as source_size,
        case when i < cut.first_open then s * cast(2 as double)
            else cast(n * w as double) / cast(2 * cut.open_w as double) end as target
    from prefix, cut
), rated as (
    select doc_id, size, source_size, target,
        case when source_size > 0 then target / source_size else cast(0 as double) end as rate,
        cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint)
            / cast(4503599627370496 as double) as draw
    from sized join goal on sized.source is not distinct from goal.source
)
select doc_id, size, source_size, target,
    size * (cast(floor(rate) as bigint) + case when draw < rate - floor(rate) then 1 else 0 end) as taken
from rated
"""

SQL["op6_winnowing_decontamination"] = r"""
with d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
), b as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark
), item_window as (
    select distinct item_id, n, list_aggregate(words[i:i + n - 1], 'string_agg', ' ') as gram from (
        select item_id, words, least(10, len(words)) as n,
            unnest(range(1, len(words) - least(10, len(words)) + 2)) as i from b where len(words) > 0)
), length_used as (select distinct n from item_window),
doc_window as (
    select doc_id, i, n, list_aggregate(words[i:i + n - 1], 'string_agg', ' ') as gram from (
        select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as i from d, length_used where len(words) >= n)
), hit as (
    select doc_id, i, doc_window.n, item_id from doc_window join item_window using (gram)
    where doc_window.n = item_window.n
), word as (select doc_id, count(distinct p) as n_hit from (
    select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from hit)) group by 1),
listed as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
    from (select distinct doc_id, cast(item_id as varchar) as id from hit) group by 1)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join word using (doc_id) left join listed using (doc_id)
"""

SQL["op8_license_scan"] = r"""
with phrase(phrase, tag) as (values ('gnu general public license', 'gpl'), ('apache license', 'apache'),
    ('cc by', 'cc-by'), ('mit license', 'mit')),
notice(label, body, required, excluded) as (values
    ('gpl-2.0', 'this work is licensed under the gnu general public license version 2', ['gnu', 'general', '2'], ['lesser', 'affero']),
    ('gpl-3.0', 'this work is licensed under the gnu general public license version 3', ['gnu', 'general', '3'], ['lesser', 'affero']),
    ('agpl-3.0', 'this work is licensed under the gnu affero general public license version 3', ['gnu', 'affero', '3'], ['']),
    ('lgpl', 'this library is licensed under the gnu lesser general public license', ['gnu', 'lesser'], ['']),
    ('apache-2.0', 'licensed under the apache license version 2 0', ['apache', '2'], ['']),
    ('cc-by-4.0', 'licensed under cc by 4 0', ['cc', 'by', '4'], ['nc', 'nd', 'sa']),
    ('cc-by-nc-4.0', 'licensed under cc by nc 4 0', ['cc', 'by', 'nc', '4'], ['nd', 'sa']),
    ('cc-by-sa-4.0', 'licensed under the creative commons attribution sharealike 4 0 international license',
        ['attribution', 'sharealike', '4'], ['noncommercial']),
    ('mit-notice', 'released under the mit license', ['mit', 'license'], ['']),
    ('mpl-2.0', 'this source code form is subject to the terms of the mozilla public license v 2 0', ['mozilla', '2'], ['']),
    ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted',
        ['redistribution', 'source', 'binary'], [''])),
low as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
    from documents
), d as (select doc_id, body, regexp_extract_all(body, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from low),
p as (select phrase, tag, string_split(phrase, ' ') as parts from phrase),
place as (
    select doc_id, tag, i - 1 as spot from (
        select doc_id, words, unnest(range(1, len(words) + 1)) as i from d
        where contains(body, 'license') or contains(body, 'cc')) x, p
    where words[i:i + len(parts) - 1] = parts
), base as (
    select doc_id, count(*) as n_base, min(spot) as first_word, max(spot) as last_word, list(distinct tag) as tags
    from place group by 1
), n as (
    select label, list_distinct(string_split(body, ' ')) as words, len(string_split(body, ' ')) * 3 // 2 as span, required, excluded
    from notice
), placed as (
    select doc_id, label, d.words, span, n.words as theirs, required, excluded,
        unnest(range(1, greatest(1, len(d.words) - span + 1) + 1)) as i
    from d, n where list_has_all(d.words, required)
), found as (
    select doc_id, label, len(list_intersect(theirs, words[i:i + span - 1])) / cast(len(theirs) as double) as part
    from placed where (' ' || array_to_string(words[i:i + span - 1], '  ') || ' ') like ('% ' || array_to_string(required, ' % ') || ' %')
        and not list_has_any(words[i:i + span - 1], excluded)
        and 100 * len(list_intersect(theirs, words[i:i + span - 1])) >= 80 * len(theirs)
), more as (select doc_id, list(distinct label) as tags, max(part) as best from found group by 1)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
    coalesce(list_aggregate(list_sort(base.tags), 'string_agg', ','), '') as base_labels,
    coalesce(list_aggregate(list_sort(list_distinct(list_concat(coalesce(base.tags, []), coalesce(more.tags, [])))),
        'string_agg', ','), '') as labels,
    case when n_base > 0 then cast(1 as double) else coalesce(best, 0) end as score
from d left join base using (doc_id) left join more using (doc_id)
"""

SQL["op12_phrase_collocations"] = r"""
with piece as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents where text <> ''
), seq as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from piece),
place as (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from seq, (values (1), (2), (3)) t(k)),
f as (
    select lang, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') as phrase, count(*) as f from place group by all
), total as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by 1),
cut as (
    select lang, k, phrase, f as a, string_split(phrase, ' ') as w, unnest(range(1, k)) as c from f where k > 1 and f >= 10
), side as (
    select cut.*, x.f as l, y.f as r, (1000000::hugeint * a * a) // (x.f::hugeint * y.f) as score
    from cut join f x on x.lang = cut.lang and x.phrase = list_aggregate(w[1:c], 'string_agg', ' ') and x.k = c
    join f y on y.lang = cut.lang and y.phrase = list_aggregate(w[c + 1:], 'string_agg', ' ') and y.k = cut.k - c
), best as (
    select * from side qualify row_number() over (partition by lang, phrase order by score, c) = 1
), inner_part as (
    select lang, a, unnest([list_aggregate(w[1:2], 'string_agg', ' '), list_aggregate(w[2:3], 'string_agg', ' ')]) as phrase
    from best where k = 3
), kept as (
    select * from best where not exists (
        select 1 from inner_part i where i.lang = best.lang and i.phrase = best.phrase and 100 * i.a >= 50 * best.a)
), ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score
from ranked join total using (lang) where rank <= 2000
"""
