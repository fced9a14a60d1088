"""DuckDB SQL for the operators whose results SQL can state over whole tables."""

from __future__ import annotations

from tripflow.llm.line_quality import NOTICES, LineRules
from tripflow.llm.url_filters import CAPITALS, DEFAULT, SMALL

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"


def url_filters() -> str:
    rules = ", ".join(
        f"('{rule.partition('/')[0]}', '/{rule.partition('/')[2]}', '{rule}', '{verdict}')"
        for rule, verdict in DEFAULT.verdicts
    )
    tracking = "|".join(DEFAULT.tracking)
    return rf"""
    with cut as (
      select page_id, url,
        case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest
      from pages),
    parts as (
      select page_id, url, regexp_extract(rest, '^[^/?#]*') as raw_host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
    hosts as (
      select page_id, coalesce(url, '') as url, path,
        translate(raw_host, '{CAPITALS}', '{SMALL}') as host from parts),
    rules(rule_host, rule_path, rule, verdict) as (values {rules}),
    fits as (
      select page_id, host, path, rule, verdict, row_number() over (
          partition by page_id order by length(rule) desc) as place
      from hosts join rules on starts_with(path, rule_path)
        and (host = rule_host or ends_with(host, '.' || rule_host)))
    select h.page_id, h.host, h.path, f.rule,
      coalesce(f.verdict, case when regexp_matches(h.url, '^[^#?]*\?([^#]*&)?({tracking})(=|&|#|$)')
        then 'block' else 'allow' end) as verdict
    from hosts h left join (select * from fits where place = 1) f using (page_id)
    """


def line_quality() -> str:
    rules = LineRules()
    notices = "|".join(NOTICES)
    return rf"""
    with texts as (
      select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
    token_lists as (select *, regexp_extract_all(text, '{WORD}') as w from texts),
    tokens as (
      select r, unnest(w) as word, generate_subscripts(w, 1) as pos from token_lists),
    windows as (
      select r, pos, case when count(*) over five = 5 then list(word) over five end as five
      from tokens window five as (
        partition by r order by pos rows between current row and 4 following)),
    often as (
      select r, pos, five is not null and count(*) over (partition by r, five) > 1 as twice
      from windows),
    covered as (
      select r, pos, max(twice) over (
        partition by r order by pos rows between 4 preceding and current row) as inside from often),
    repeats as (select r, count(*) filter (inside) as n from covered group by r),
    line_lists as (select r, string_split(text, chr(10)) as l from texts),
    lines as (select r, unnest(l) as line, generate_subscripts(l, 1) as pos from line_lists),
    worded as (
      select *, regexp_extract_all(line, '{WORD}') as t from lines
      where regexp_matches(line, '{WORD}')),
    counted as (
      select *, len(t) as n, row_number() over (partition by r, line order by pos) > 1 as again,
        len(list_filter(t, lambda x: regexp_full_match(x, '{SYMBOL}+'))) as alone,
        length(line) - length(regexp_replace(line, '{SYMBOL}', '', 'g')) as symbols,
        len(list_filter(t, lambda x: ends_with(x, '!'))) as loud,
        len(list_filter(range(1, len(t)), lambda i: t[i] = t[i + 1])) as stutters
      from worded),
    judged as (
      select r, n, again,
        100 * alone > {rules.navigation_percent} * n
        or 100 * symbols > {rules.symbols_percent} * n
        or 100 * loud > {rules.shouting_percent} * n
        or 100 * stutters > {rules.stutter_percent} * n
        or n <= {rules.boilerplate_words} and regexp_matches(lower(line), '{notices}')
        or again
        or n > {rules.unpunctuated_words} and not regexp_matches(line, '[.!?…;:]') as fails
      from counted),
    by_line as (
      select r, count(*) filter (again) as n_dup_lines,
        coalesce(sum(n) filter (fails), 0)::bigint as lost_words from judged group by r),
    base as (
      select doc_id, len(w)::bigint as n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
        (length(text) - length(regexp_replace(text, '{SYMBOL}', '', 'g')))::bigint as n_symbols,
        coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
        coalesce(n, 0)::bigint as n_repeat_words,
        coalesce(lost_words, 0)::bigint as lost_words
      from token_lists left join repeats using (r) left join by_line using (r)),
    failed as (
      select *, n_words < {rules.min_words}
        or 100 * n_repeat_words > {rules.max_repeat_percent} * n_words as base_failed from base)
    select *, not base_failed and 100 * lost_words <= {rules.max_lost_percent} * n_words as kept
    from failed
    """


def near_copies() -> str:
    return rf"""
    with recursive texts as (
      select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{WORD}') as w from documents),
    shingles as (
      select distinct doc_id, unnest(case when len(w) = 0 then []
        when len(w) < 4 then [hash(w)]
        else list_transform(range(1, len(w) - 2), lambda i: hash(w[i:i + 3])) end) as s
      from texts),
    sizes as (select doc_id, count(*) as n from shingles group by doc_id),
    shared as (
      select a.doc_id as a, b.doc_id as b, count(*) as common
      from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
    links as (
      select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
      where 100 * common >= 80 * (x.n + y.n - common)),
    ways as (select a, b from links union all select b, a from links),
    reach(doc_id, other) as (
      select a, b from ways
      union select reach.doc_id, ways.b from reach join ways on reach.other = ways.a),
    roots as (select doc_id, min(other) as least from reach group by doc_id)
    select doc_id, coalesce(n, 0)::bigint as n_shingles,
      least(doc_id, coalesce(least, doc_id)) as component_id,
      doc_id = least(doc_id, coalesce(least, doc_id)) as kept
    from documents left join sizes using (doc_id) left join roots using (doc_id)
    """


def lexical_search() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return rf"""
    with texts as (
      select row_number() over () as d, doc_id,
        regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{term}') as w
      from documents where text is not null),
    worded as (select d, doc_id, w, len(w)::bigint as n from texts where len(w) > 0),
    corpus as (select count(*)::bigint as n_docs, sum(n)::bigint as total from worded),
    each as (select d, unnest(w) as t from worded),
    postings as (select d, t, count(*)::bigint as tf from each group by all),
    weights as (
      select t, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w
      from postings, corpus group by t, n_docs),
    asked as (
      select row_number() over () as q, item_id,
        regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{term}') as terms
      from benchmark),
    query_terms as (select q, item_id, unnest(terms) as t from asked),
    scores as (
      select q, item_id, d, doc_id, sum(weights.w *
        ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // total)))
        )::bigint as score
      from query_terms join postings using (t) join weights using (t) join worded using (d), corpus
      group by all),
    ranked as (
      select *, row_number() over (partition by q order by score desc, doc_id nulls last) as rank
      from scores where score > 0)
    select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
    """


def vector_copies() -> str:
    return """
    with recursive vectors as (
      select vec_id, label, embedding::double[] as v,
        sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) as size
      from embeddings
      where label is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    links as (
      select a.vec_id as a, b.vec_id as b from vectors a join vectors b
        on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
      where a.size > 0 and b.size > 0
        and list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.98),
    reach(vec_id, other) as (
      select a, b from links
      union select reach.vec_id, links.b from reach join links on reach.other = links.a),
    roots as (select vec_id, min(other) as least from reach group by vec_id),
    counts as (select a as vec_id, count(*) as n from links group by a)
    select vec_id, coalesce(n, 0)::bigint as n_links,
      least(vec_id, coalesce(least, vec_id)) as component_id,
      vec_id = least(vec_id, coalesce(least, vec_id)) as kept
    from embeddings left join counts using (vec_id) left join roots using (vec_id)
    """


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filters": url_filters(),
        "op4_line_quality": line_quality(),
        "op10_near_copies": near_copies(),
        "op11_lexical_search": lexical_search(),
        "op12_vector_copies": vector_copies(),
    }
