"""The bound queries in SQL, for DuckDB over the same stored tables."""

from checks import params
from galewatch.functions import wordlists
from galewatch.operators.geo import COLORS, DAMAGE

RULES = params.RULES


def quoted(values) -> str:
    return "(" + ", ".join("'" + value.replace("'", "''") + "'" for value in sorted(values)) + ")"


def rows(values) -> str:
    return ", ".join("(" + ", ".join(map(str, value)) + ")" for value in values)


ORACLES: dict[str, str] = {}

CREATED_AT = "strftime(ts, '%a %b %d %H:%M:%S +0000 %Y')"
LABELLED = "(select d.*, quality, toxic, quality || '_' || toxic as label from documents d join labels using (doc_id))"

# ---- import-time pipeline -----------------------------------------------------

ORACLES["flatten_nested"] = f"""
select event_id as tweet_id, {CREATED_AT} as tweet_date_full,
  case when event_type <> 'error' then value end as lat, case when event_type <> 'error' then -value end as lon,
  case when event_type <> 'view' then event_type || ', TX' end as tweet_place, 'storm' as crisis_name,
  user_id, 'user ' || user_id as user_name, event_type as user_location, floor(value)::bigint as user_followers,
  event_type = 'purchase' as user_verified, props as text, event_type || ',Storm' as hashtags,
  strftime(ts, '%a %b %d') as tweet_date, strftime(ts, '%H:%M:%S') as tweet_time
from events"""

ORACLES["parse_created_at"] = """
select event_id, strftime(ts, '%a %b %d') as tweet_date, strftime(ts, '%H:%M:%S') as tweet_time,
  date_trunc('second', ts)::timestamp as created_ts
from events"""

ORACLES["union_all"] = """
select conv_id as id, turn, role, text, null::varchar as lang, null::varchar as source, null::bigint as n_chars
from conversations
union all select doc_id, null, null, text, lang, source, n_chars from documents"""

ORACLES["label_join_stored"] = "select d.*, quality, toxic from documents d join labels using (doc_id)"

ORACLES["label_join"] = f"select * from {LABELLED}"

MALFORMED = "event_id % 97 = 5"
ORACLES["json_scan"] = f"{ORACLES['flatten_nested']} where not ({MALFORMED})"
ORACLES["json_quarantine"] = f"select 'malformed' as dataset, count(*) as \"count\" from events where {MALFORMED}"

TEXT_ID, WRONG_USER, CUT_OFF = "event_id % 7 = 3", "event_id % 11 = 4", "event_id % 13 = 5"
ORACLES["json_quarantine_fields"] = f"""
select 'events' as file, field, count(*) as "count" from (
  select null::varchar as field from events where {CUT_OFF}
  union all select 'id' from events where {TEXT_ID} and not ({CUT_OFF})
  union all select unnest(['user.followers_count', 'user.verified']) from events where {WRONG_USER} and not ({CUT_OFF}))
group by 2"""

ORACLES["label_scan"] = """
select doc_id::varchar as tweet_id, quality || '_' || toxic as "AIDRLabel",
  case when quality = 1 then '0.' || toxic end as "AIDRConfidence"
from labels"""

# ---- previews -------------------------------------------------------------------

ORACLES["dataset_preview"] = """
select doc_id::varchar as doc_id, text, lang, source, n_chars
from documents order by md5(doc_id::varchar || ':44'), documents.doc_id limit 15"""

ORACLES["sample_n"] = "select * from labels order by md5(doc_id::varchar || ':42'), doc_id limit 15"

ORACLES["dataset_count"] = """
select 'documents' as dataset, count(*) as "count" from documents
union all select 'labels', count(*) from labels"""

# ---- counts ---------------------------------------------------------------------

ORACLES["flag_counts"] = """
select event_type = 'purchase' as verified, count(*) as "count" from events where event_type <> 'error' group by 1"""

ORACLES["date_counts"] = """select strftime(ts, '%m-%d') as tweet_date, count(*) as "count" from events group by 1"""

HOURLY = """(select strftime(ts, '%a %b %d') as tweet_date, hour(ts)::integer as tweet_hour, count(*) as "count"
  from events group by 1, 2)"""

ORACLES["avg_per_hour"] = f"""select tweet_hour, avg("count") as avg_tweet_count from {HOURLY} group by 1"""

ORACLES["running_avg"] = f"""
select tweet_date, tweet_hour, "count",
  avg("count") over (partition by tweet_date order by tweet_hour) as avg_tweet_count
from {HOURLY}"""

ORACLES["avg_per_hour_stored"] = ORACLES["avg_per_hour"]
ORACLES["running_avg_stored"] = ORACLES["running_avg"]

ORACLES["label_counts"] = f"""select label, count(*) as "count" from {LABELLED} group by 1"""

ORACLES["distinct_labels"] = f"select distinct label from {LABELLED}"

STATE_TESTS = " or ".join(f"state like '%{state}%'" for state in params.STATES)
ORACLES["state_counts"] = f"""
select state, count(*) as "count" from (
  select case when strpos(place, ',') > 0 then split_part(place, ',', 2) end as state from (
    select case when r_name = 'EUROPE' then n_name else n_name || ', ' || r_name end as place
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey))
where ({STATE_TESTS}) and state like ' %' group by 1"""

# ---- words ------------------------------------------------------------------------

ORACLES["word_topk"] = f"""
select word, count(*) as "count" from (select unnest(regexp_split_to_array(lower(text), '\\W+')) as word from documents)
where word <> '' and word not in {quoted(wordlists.ENGLISH | wordlists.OVERALL_TERMS)}
group by 1 order by 2 desc, 1 limit 20"""

ORACLES["word_topk_by_label"] = f"""
with counted as (
  select label, word, count(*) as "count"
  from (select label, unnest(regexp_split_to_array(lower(text), '\\W+')) as word from {LABELLED})
  where word <> '' and word not in {quoted(wordlists.ENGLISH | wordlists.PER_LABEL_TERMS)} group by 1, 2)
select label, word, "count", (row_number() over (partition by label order by "count" desc, word))::integer as rank
from counted qualify rank <= 20"""

ORACLES["hashtag_topk"] = """
select word, count(*) as "count" from (
  select unnest(string_split(lower(tag), ',')) as word
  from (select unnest([replace(p_name, ' ', ','), upper(p_type)]) as tag from part))
group by 1 order by 2 desc, 1 limit 15"""

# ---- maps -------------------------------------------------------------------------

MESSAGE_COLOR, DAMAGE_COLOR = (",".join(map(str, COLORS[kind])) for kind in ("Tweet", "Damage"))
ORACLES["geo_points_union"] = f"""
select embedding[1]::double as lat, embedding[2]::double as lon, 'Tweet' as type, '{MESSAGE_COLOR}' as color
from embeddings where embedding is not null
union all select lat::double, lon::double, 'Damage', '{DAMAGE_COLOR}' from (values {rows(DAMAGE)}) points(lat, lon)"""

ORACLES["trajectory_segments"] = """
select * from (
  select label as track, vec_id as seq, embedding[1]::double as start_lat, embedding[2]::double as start_lon,
    lead(embedding[1]::double) over track as end_lat, lead(embedding[2]::double) over track as end_lon
  from embeddings window track as (partition by label order by vec_id))
where end_lat is not null"""

# ---- sentiment --------------------------------------------------------------------


def known(back: int) -> str:
    """Whether the word so many tokens before is in the lexicon itself."""
    return f"coalesce(lower(prev{back}) in {quoted(word for word, _ in params.LEXICON)}, false)"


def boost_step(back: int) -> str:
    """Valence after the booster and the negation ``back`` tokens before."""
    prev, damping = f"prev{back}", RULES.damping[back - 1]
    boosted = f"""v + coalesce(
      case when v < 0 then -1 else 1 end
        * case when lower({prev}) in {quoted(RULES.intensifiers)} then {RULES.boost}::double
               when lower({prev}) in {quoted(RULES.dampeners)} then -{RULES.boost}::double end
        + case when mixed and upper({prev}) = {prev} and lower({prev}) <> {prev}
               then case when v > 0 then {RULES.shout}::double else -{RULES.shout}::double end
               else 0::double end, 0::double) * {damping}::double"""
    praise = {
        1: "",
        2: "when prev2 = 'never' and prev1 in ('so', 'this') then 1.5::double",
        3: """when prev3 is not null and ((prev3 = 'never' and prev2 in ('so', 'this')) or prev1 in ('so', 'this'))
               then 1.25::double""",
    }[back]
    return f"""case when {known(back)} then v else ({boosted}) * case {praise}
      when lower({prev}) in {quoted(RULES.negations)} or lower({prev}) like '%n''t%' then {RULES.negate}::double
      else 1::double end end"""


def idiom(words: str) -> str:
    hits = " ".join(f"when '{phrase}' then {value}::double" for phrase, value in RULES.idioms.items())
    return f"(case {words} {hits} end)"


PHRASED = f"""case when v is null or prev3 is null or {known(3)} then v else coalesce(
    case when next2 is not null then {idiom("token || ' ' || next1 || ' ' || next2")} end,
    case when next1 is not null then {idiom("token || ' ' || next1")} end,
    {idiom("prev1 || ' ' || token")}, {idiom("prev2 || ' ' || prev1 || ' ' || token")},
    {idiom("prev2 || ' ' || prev1")}, {idiom("prev3 || ' ' || prev2 || ' ' || prev1")},
    {idiom("prev3 || ' ' || prev2")}, v)
  + case when prev3 || ' ' || prev2 in {quoted(RULES.dampening_phrases)}
           or prev2 || ' ' || prev1 in {quoted(RULES.dampening_phrases)} then -{RULES.boost}::double
         else 0::double end end"""

SPACE = r"[\s\p{Z}]+"
MARK = r"(?:\?!\?!|!\?!\?|\?!\?|!\?!|!!!|\?\?\?|!!|\?\?|[.!?,;:'\"-])"
PLAIN = r"[^\s\p{Z}!-/:-@\[-`{-~]{2,}"
EDGE_OR_BARE = f"^(?:{MARK}({PLAIN})|({PLAIN}){MARK})$".replace("'", "''")
SHOUTED = "upper(x) = x and lower(x) <> x"


def scored(documents: str) -> str:
    """CTEs ending in ``scored`` (doc_id, text, copies, score, sentiment) of a relation's texts."""
    near = ", ".join(
        [f"case when pos >= {k} then tokens[pos + 1 - {k}] end as prev{k}" for k in (1, 2, 3)]
        + [f"tokens[pos + 1 + {k}] as next{k}" for k in (1, 2)]
    )
    steps = [
        ("shouting", f"case when mixed and {SHOUTED.replace('x', 'token')} then v + case when v > 0 "
         f"then {RULES.shout}::double else -{RULES.shout}::double end else v end"),
        *[(f"boosted{back}", boost_step(back)) for back in (1, 2, 3)],
        ("idiomatic", PHRASED),
        ("contrasted", f"""v
          * case when lower(prev1) = 'least' and not {known(1)} and not coalesce(lower(prev2) in ('at', 'very'), false)
                 then {RULES.negate}::double else 1::double end
          * case when turn > 0 and pos + 1 < turn then {RULES.before_contrast}::double
                 when turn > 0 and pos + 1 > turn then {RULES.after_contrast}::double else 1::double end"""),
    ]
    ctes, source = [], "met"
    for name, expression in steps:
        ctes.append(f"{name} as (select * exclude (v), {expression} as v from {source})")
        source = name
    return f"""
texts as (
  select doc_id, text, list_transform(
      list_filter(string_split_regex(text, '{SPACE}'), lambda x: length(x) > 1),
      lambda x: regexp_replace(x, '{EDGE_OR_BARE}', '\\1\\2')) as tokens
  from {documents} where text is not null),
marked as (
  select doc_id, text, tokens,
    least(length(text) - length(replace(text, '!', '')), {RULES.most_exclamations}) * {RULES.exclamation}::double
      + case when length(text) - length(replace(text, '?', '')) > {RULES.most_questions}
             then {RULES.many_questions}::double
             when length(text) - length(replace(text, '?', '')) > 1
             then (length(text) - length(replace(text, '?', ''))) * {RULES.question}::double
             else 0::double end as emphasis,
    len(list_filter(tokens, lambda x: {SHOUTED})) between 1 and len(tokens) - 1 as mixed,
    coalesce(list_position(list_transform(tokens, lambda x: lower(x)), '{RULES.contrast}'), 0) as turn
  from texts),
placed as (
  select doc_id, mixed, turn, tokens, unnest(tokens) as token, generate_subscripts(tokens, 1) - 1 as pos from marked),
near as (select doc_id, mixed, turn, pos, token, lower(token) as word, {near} from placed),
met as (
  select near.*, case when word not in {quoted([*RULES.intensifiers, *RULES.dampeners])}
      and not (word = 'kind' and coalesce(lower(next1) = 'of', false)) then valence end as v
  from near join (values {rows((f"'{word}'", f"{value}::double") for word, value in params.LEXICON)})
    lexicon(word, valence) using (word)),
{", ".join(ctes)},
summed as (
  select doc_id, sum(coalesce(round(v * 1e8::double)::bigint, 0))::bigint as units from {source} group by 1),
totals as (
  select doc_id, text, emphasis, coalesce(units, 0)::double / 1e8::double as total
  from marked left join summed using (doc_id)),
emphatic as (select doc_id, text, total + sign(total)::double * emphasis as total from totals),
rated as (
  select doc_id, text, round(total / sqrt(total * total + {RULES.alpha}::double), 4) as score from emphatic),
scored as (
  select doc_id, text, 1::bigint as copies, score,
    case when score >= {RULES.threshold} then 'positive' when score <= -{RULES.threshold} then 'negative'
         else 'neutral' end as sentiment
  from rated)"""


PLACE = "case " + " ".join(f"when lang = '{k}' then '{v}'" for k, v in params.PLACES.items()) + " end"
STATE = f"case when strpos({PLACE}, ',') > 0 then split_part({PLACE}, ',', 2) end"
PLACED = " or ".join(f"{STATE} like '%{state}%'" for state in params.PLACED)
POLAR = f"(select * from {LABELLED} where {PLACED})"
COUNTS = 'select sentiment, sum(copies)::bigint as "count" from scored group by 1'
SAMPLES = """select doc_id, text, sentiment, score,
  (row_number() over (partition by sentiment order by doc_id))::integer as rank
from scored qualify rank <= 5"""

ORACLES["sentiment_score"] = f"with {scored('documents')} select doc_id, copies, score, sentiment from scored"
ORACLES["sentiment_counts"] = f"with {scored('documents')} {COUNTS}"
ORACLES["sentiment_samples"] = f"with {scored('documents')} {SAMPLES}"
ORACLES["sentiment_counts_by_state"] = f"with {scored(POLAR)} {COUNTS}"
ORACLES["sentiment_samples_by_state"] = f"with {scored(POLAR)} {SAMPLES}"

# ---- learning ---------------------------------------------------------------------

ORACLES["feature_encode"] = f"""
with joined as (select * from {LABELLED}),
     langs as (select lang, (row_number() over (order by count(*) desc, lang) - 1)::double as lang_index
               from joined group by lang)
select doc_id, n_chars::double as n_chars, lang_index, quality::double as confidence_numeric,
  case when toxic = 1 then 1 else 0 end::integer as flag_index
from joined join langs using (lang) where source <> 'src3'"""

ORACLES["label_index"] = """
select lang, (row_number() over (order by count(*) desc, lang) - 1)::integer as label_index, count(*) as "count"
from documents group by lang"""


def correlations(columns, source: str) -> str:
    """One row (feature_x, feature_y, corr) per pair."""
    cells = [
        f"select '{x}' as feature_x, '{y}' as feature_y, "
        + ("1::double" if x == y else f"corr({x}::double, {y}::double)")
        + f" as corr from {source}"
        for x in columns
        for y in columns
    ]
    return " union all ".join(cells)


ORACLES["correlation"] = f"""
with joined as materialized (select * from {LABELLED})
select feature_x, feature_y, round(max(corr), 6) as corr
from ({correlations(params.FEATURES, "joined")}) group by 1, 2"""

ORACLES["correlation_of_matrix"] = f"""
with joined as materialized (select * from {LABELLED}),
cells as ({correlations(params.FEATURES, "joined")}),
pairs as (select feature_x, feature_y, max(corr) as corr from cells group by 1, 2),
matrix as (
  select feature_x as feature, {", ".join(f"max(corr) filter (feature_y = '{y}') as {y}" for y in params.FEATURES)}
  from pairs group by 1)
select feature_x, feature_y, round(max(corr), 6) as corr
from ({correlations(params.FEATURES, "matrix")}) group by 1, 2"""

ORACLES["hash_split"] = """
select * exclude (h), case when h < '99999999' then 'train' when h < 'cccccccc' then 'val' else 'test' end as split
from (select *, md5(doc_id::varchar || ':123') as h from documents)"""

RATES = f"""
with pairs as (select quality as y, (n_chars >= {params.LONG_TEXT})::integer as p from {LABELLED}),
actual as (select y, count(*) as support, sum((y = p)::integer)::double as hits from pairs group by 1),
guessed as (select p as y, count(*) as predicted from pairs group by 1),
rates as (
  select y as label, coalesce(hits / predicted, 0) as precision, hits / support as recall, support, hits
  from actual left join guessed using (y))"""

ORACLES["metrics_by_label"] = f"""{RATES}
select label, precision, recall,
  case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1, support
from rates"""

ORACLES["metrics_overall"] = f"""{RATES}
select 'Precision' as metric, round(sum(precision * support) / sum(support), 9) as value from rates
union all select 'Recall', round(sum(recall * support) / sum(support), 9) from rates
union all select 'Accuracy', round(sum(hits) / sum(support), 9) from rates"""

TOPICS = f"""
topics as (
  select * replace (case when quality = 1 then 'good' else 'poor' end as label), md5(doc_id::varchar || ':123') as h
  from {LABELLED}),
tested as (select label, count(*) as support from topics where h >= 'cccccccc' group by 1)"""
# The confidence separates the labels, so a trained model makes no mistake.
RIGHT = f"""with {TOPICS}
select label, 1::double as precision, 1::double as recall, 1::double as f1, support,
  1::double as val_accuracy, 1::double as test_accuracy
from tested"""
ORACLES["classify_rf"] = RIGHT
ORACLES["classify_lr"] = RIGHT
ORACLES["classify_overall"] = "select unnest(['Precision', 'Recall', 'Accuracy']) as metric, 1::double as value"
ORACLES["classify_distribution"] = f"""
with {TOPICS}
select label, (row_number() over (order by count(*) desc, label) - 1)::integer as label_index, count(*) as "count"
from topics group by label"""

ENCODED = ("user_followers", "AIDRLabel_index", "AIDRConfidence_numeric", "user_verified_index")
ORACLES["feature_correlation"] = f"""
with {TOPICS},
topic as (select label, (row_number() over (order by count(*) desc, label) - 1) as i from topics group by label),
encoded as materialized (
  select n_chars as user_followers, i as AIDRLabel_index, quality as AIDRConfidence_numeric, toxic as user_verified_index
  from topics join topic using (label) where n_chars % 5 <> 0)
select feature_x, feature_y, round(max(corr), 6) as corr
from ({correlations(ENCODED, "encoded")}) group by 1, 2"""

ORACLES["classify_rf_overall"] = ORACLES["classify_overall"]
ORACLES["classify_rf_distribution"] = ORACLES["classify_distribution"]
