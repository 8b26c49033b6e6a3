"""Text rules over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import framing, places, scores, text, web
from tidemark.operators import audit, excerpts
from tidemark.plans.registry import query, table


def docs(spark, d):
    return table(spark, d, "documents")


SQUEEZED = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


@query("x1_normalised", rf"select doc_id, md5(replace(lower({SQUEEZED}), 'ß', 'ss')) as folded from documents")
def x1(spark, d):
    return docs(spark, d).select("doc_id", F.md5(text.normalised(F.col("text"))).alias("folded"))


@query("x2_text_hash", rf"select doc_id, case when length(n) < 200 then '' else sha256(n) end as hash from (select doc_id, replace(lower({SQUEEZED}), 'ß', 'ss') as n from documents)")
def x2(spark, d):
    return docs(spark, d).select("doc_id", text.text_hash(F.col("text")).alias("hash"))


@query("x4_named_words", r"""
with w as (select * from (values ('A', '(^|[^\w-])(the|that)s?([^\w]|$)'), ('B', '(^|[^\w-])(Er|Die)s?([^\w]|$)|(^|[^\w])([Ee]nt)\w{0,4}'), ('C', '(^|[^\w-])(ment)s?([^\w]|$)')) t(code, p))
select doc_id, coalesce(list_sort(list(code) filter (where regexp_matches(regexp_replace(text, '[^A-Za-z0-9\s-]', '.', 'g'), p))), []) as codes from documents, w group by 1""")
def x4(spark, d):
    # the rule on words that the invented prose has; letters beyond ASCII become full stops, as SQL's \w is ASCII only
    plain = F.regexp_replace("text", r"[^A-Za-z0-9\s-]", ".")
    codes = places.named(plain, {"A": ["the", "that"], "B": ["Er", "Die"], "C": ["ment"]}, {"B": ["ent"]})
    return docs(spark, d).select("doc_id", codes.alias("codes"))


def _planted() -> list[str]:
    """Every alias and adjective of the tables, one for each row in turn, in an English frame."""
    return [f"News of {n}'s envoy." for some in (*places.NAMES.values(), *places.ADJECTIVES.values()) for n in some]


def _country_forms() -> list[tuple[str, str, str]]:
    """Code, form and pattern of every alias and adjective, for SQL's engine, which has no look-around: what may stand before and after is matched too."""
    letter, quoted = r"\p{L}\p{N}_", lambda n: n.replace("'", "''")
    after = {"Washington": rf"(s?$|s[^{letter}]|[^{letter} s]| ($|[^P]|P($|[^o]|o($|[^s]|s($|[^t])))))"}
    names = [(c, quoted(n), rf"(^|[^{letter}-]){quoted(n).replace('.', chr(92) + '.')}" + after.get(n, rf"s?($|[^{letter}])")) for c, some in places.NAMES.items() for n in some]
    return names + [(c, quoted(f), rf"(^|[^{letter}]){quoted(f)}") for c, some in places.ADJECTIVES.items() for n in some for f in dict.fromkeys([n, n[0].upper() + n[1:]])]


@query("x4_named_countries", "with p as (select * from (values " + ", ".join(f"('{c}', '{f}', '{p}')" for c, f, p in _country_forms()) + f""") t(code, form, p)),
said as (select doc_id, coalesce(text, '') || ' ' || string_split('{"|".join(_planted()).replace("'", "''")}', '|')[cast(doc_id % {len(_planted())} + 1 as integer)] as t from documents),
hits as (select distinct doc_id, code from said, p where case when contains(t, form) then regexp_matches(t, p) else false end)
select doc_id, coalesce(codes, []) as codes from said left join (select doc_id, list_sort(list(code)) as codes from hits group by 1) using (doc_id)""")
def x4_countries(spark, d):
    # the invented prose hardly names a country, so every alias and adjective is put at the end of some text; whole texts are searched for all of them
    planted = _planted()
    said = F.concat(F.coalesce("text", F.lit("")), F.lit(" "), F.get(F.split(F.lit("|".join(planted)), r"\|"), (F.col("doc_id") % len(planted)).cast("int")))
    return docs(spark, d).select("doc_id", places.named(said, places.NAMES).alias("codes"))


@query("x5_item_text", "select doc_id, md5(coalesce(text, '') || ' ' || chr(10) || ' ' || '' || ' ' || chr(10) || ' ' || coalesce(lang, '')) as m from documents")
def x5(spark, d):
    return docs(spark, d).select("doc_id", F.md5(places.item_text(F.col("text"), F.lit(None).cast("string"), F.col("lang"))).alias("m"))


NAMES = ("The_Guardian_0101.pdf", "Die Welt - 3 May 2024.pdf", "Welt am Sonntag.pdf", "la-times 4.pdf", "The Times UK.pdf", "wsj_2708.pdf", "WSJ Magazine.pdf", "USA Today Sports Weekly.pdf", "TE-2024-05-01 WEB.pdf", "Dein Spiegel.pdf", "Der_Spiegel_12.pdf", "FAZ 2.pdf", "other.pdf")


@query("x6_recognised_title", """
select supplier.s_suppkey, [""" + ", ".join("'" + n + "'" for n in NAMES) + """][s_suppkey % 13 + 1] as name,
       ['Guardian', 'Die Welt', null, 'Los Angeles Times', null, 'Wall Street Journal', null, null, 'Economist', null, 'Der Spiegel', 'Frankfurter Allgemeine Zeitung', null][s_suppkey % 13 + 1] as title from supplier""")
def x6(spark, d):
    name = F.get(F.array(*map(F.lit, NAMES)), (F.col("s_suppkey") % len(NAMES)).cast("int"))
    return table(spark, d, "supplier").select("s_suppkey", name.alias("name"), places.recognised_title(name).alias("title"))


AGENTS = ("Mozilla/5.0 Chrome/1 Safari/1 Edg/1", "Mozilla/5.0 Chrome/1 Safari/1 OPR/9", "Mozilla/5.0 (Linux; Android 1) Chrome/1 Mobile", "Firefox/3", "Version/1 Safari/5 (iPad)", "curl/8", "")


@query("x7_browser", "select event_id, ['Edge', 'Opera', 'Chrome', 'Firefox', 'Safari', 'Other', 'Other'][event_id % 7 + 1] as browser from events")
def x7(spark, d):
    agent = F.get(F.array(*map(F.lit, AGENTS)), (F.col("event_id") % 7).cast("int"))
    return table(spark, d, "events").select("event_id", web.browser_family(agent).alias("browser"))


@query("x8_device", "select event_id, ['desktop', 'desktop', 'mobile', 'desktop', 'mobile', 'desktop', 'other'][event_id % 7 + 1] as device from events")
def x8(spark, d):
    agent = F.get(F.array(*map(F.lit, AGENTS)), (F.col("event_id") % 7).cast("int"))
    return table(spark, d, "events").select("event_id", web.device_family(agent).alias("device"))


@query("x9_primary_language", r"select page_id, case when l = '' then 'unknown' else lower(split_part(split_part(l, '-', 1), ';', 1)) end as language from (select page_id, coalesce(regexp_extract(html, '<html lang=\"([^\"]*)\"', 1), '') || case page_id % 3 when 0 then '-XX,de;q=0.5' when 1 then ';q=1, fr' else '' end as l from pages)")
def x9(spark, d):
    header = F.concat(F.regexp_extract("html", '<html lang="([^"]*)"', 1), F.when(F.col("page_id") % 3 == 0, "-XX,de;q=0.5").when(F.col("page_id") % 3 == 1, ";q=1, fr").otherwise(""))
    return table(spark, d, "pages").select("page_id", web.primary_language(header).alias("language"))


@query("x10_referrer_host", r"select page_id, case when page_id % 9 = 0 then 'direct' else lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) end as host from pages")
def x10(spark, d):
    url = F.when(F.col("page_id") % 9 == 0, F.when(F.col("page_id") % 2 == 0, "no address")).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", web.referrer_host(url).alias("host"))


@query("x11_gist", "select doc_id, case when length(trim(text)) > 280 then left(trim(text), 280) || '...' else trim(text) end as gist from documents")
def x11(spark, d):
    return docs(spark, d).select("doc_id", text.gist(F.col("text")).alias("gist"))


@query("x12_first_words", rf"select doc_id, array_to_string(string_split({SQUEEZED}, ' ')[1:6], ' ') as head from documents")
def x12(spark, d):
    return docs(spark, d).select("doc_id", text.first_words(F.col("text")).alias("head"))


@query("x13_word_count", rf"select doc_id, case when {SQUEEZED} = '' then 0 else len(string_split({SQUEEZED}, ' ')) end as words from documents")
def x13(spark, d):
    return docs(spark, d).select("doc_id", text.word_count(F.col("text")).alias("words"))


@query("x14_over_ceiling", rf"select doc_id, len(string_split({SQUEEZED}, ' ')) > 250 as strict, len(string_split({SQUEEZED}, ' ')) > 275 as tolerant from documents where {SQUEEZED} != ''")
def x14(spark, d):
    strict, tolerant = text.over_ceiling(text.word_count(F.col("text")), 250)
    return docs(spark, d).where(text.squeezed(F.col("text")) != "").select("doc_id", strict.alias("strict"), tolerant.alias("tolerant"))


@query("x15_foreign_letters", r"select doc_id, list_sort(list_distinct(regexp_extract_all(text, '[éèßñ]'))) as letters from documents")
def x15(spark, d):
    return docs(spark, d).select("doc_id", text.foreign_letters(F.regexp_replace("text", r"[^éèßñ\sA-Za-z]", ""), "[A-Za-z]").alias("letters"))


@query("x16_tells", "select doc_id, [t for t in ['the ', 'idiot', 'ung', 'quoi'] if contains(text, t)] as found from documents")
def x16(spark, d):
    return docs(spark, d).select("doc_id", text.tells(F.col("text"), ["the ", "idiot", "ung", "quoi"]).alias("found"))


@query("x17_mixed_words", r"select doc_id, [w for w in regexp_extract_all(text, '[\p{L}\p{M}]+') if regexp_matches(w, '[éè]') and regexp_matches(w, '[A-Z]')] as words from documents")
def x17(spark, d):
    return docs(spark, d).select("doc_id", text.mixed_script_words(F.col("text"), "[éè]", "[A-Z]").alias("words"))


@query("x18_prefix_repair", r"select doc_id, md5(regexp_replace(regexp_replace(text, '(^|[^\p{L}])(é)([a-z])', '\1\2-\3', 'g'), '(^|[^\p{L}])(éé+)([a-z])', '\1\2 \3', 'g')) as repaired from documents")
def x18(spark, d):
    return docs(spark, d).select("doc_id", F.md5(text.joined_prefix_repaired(F.col("text"), "é", "[a-z]")).alias("repaired"))


@query("x19_leftover_tags", r"select page_id, cast(len(regexp_extract_all(html, '</?\w+>?')) as integer) as n from pages")
def x19(spark, d):
    return table(spark, d, "pages").select("page_id", F.size(text.leftover_tags(F.col("html"))).alias("n"))


@query("x20_script_ratio", r"select doc_id, case when length(regexp_replace(text, '[^\p{L}]', '', 'g')) >= 40 then round(length(regexp_replace(text, '[^a-z]', '', 'g')) / length(regexp_replace(text, '[^\p{L}]', '', 'g')), 6) end as ratio from documents")
def x20(spark, d):
    return docs(spark, d).select("doc_id", F.round(text.script_ratio(F.col("text"), "a-z"), 6).alias("ratio"))


ALLOWED = r"[\x00-\x7FÀ-ÿ]"


@query("x21_defects", r"""
with d as (select doc_id, case when regexp_matches(text, '[^\x00-\x7FÀ-ÿ]') then 'foreign_chars' end as a,
    case when len([w for w in regexp_extract_all(text, '[\p{L}\p{M}]+') if regexp_matches(w, '[éè]') and regexp_matches(w, '[A-Z]')]) > 0 then 'mixed_script' end as b,
    case when regexp_matches(text, '</?[A-Za-z_]') then 'tag_fragment' end as c,
    case when length(regexp_replace(text, '[^\p{L}]', '', 'g')) >= 40 and length(regexp_replace(text, '[^a-m]', '', 'g')) / length(regexp_replace(text, '[^\p{L}]', '', 'g')) < 0.35 then 'low_script_ratio' end as e from documents)
select doc_id, list_sort([x for x in [a, b, c, e] if x is not null]) as kinds, coalesce(case when a is not null then 'foreign_script_chars' end, b, c, e, 'suspicious') as priority from d""")
def x21(spark, d):
    found = docs(spark, d).select("doc_id", text.text_defects(F.col("text"), ALLOWED, ("[éè]", "[A-Z]"), "a-m").alias("found"))
    return found.select("doc_id", F.array_sort(F.map_keys("found")).alias("kinds"), text.priority_defect(F.col("found")).alias("priority"))


@query("x22_name_forms", r"select doc_id, cast(len(regexp_extract_all(text, '(?:^|[^A-Za-z])(the)')) as integer) as forms from documents")
def x22(spark, d):
    return docs(spark, d).select("doc_id", F.regexp_count("text", F.lit("(?<![A-Za-z])the")).alias("forms"))


@query("x23_suspicious", r"select doc_id, length(text) < 50 or regexp_matches(text, '</\w+') or regexp_matches(trim(text), '^\d+$') as suspicious from documents")
def x23(spark, d):
    return docs(spark, d).select("doc_id", text.is_suspicious(F.col("text")).alias("suspicious"))


def _planted_sql(sentences) -> str:
    """Documents with one of some sentences before each text, in turn."""
    listed = ", ".join("'" + x.replace("'", "''") + "'" for x in sentences)
    return f"said as (select doc_id, [{listed}][doc_id % {len(sentences)} + 1] || ' ' || coalesce(text, '') as t from documents)"


def _with_planted(spark, d, sentences):
    first = F.get(F.array(*map(F.lit, sentences)), (F.col("doc_id") % len(sentences)).cast("int"))
    return docs(spark, d).select("doc_id", F.concat(first, F.lit(" "), F.coalesce("text", F.lit(""))).alias("said"))


CLAIMS = ("Here two daily newspapers differ.", "Some 12 outlets say so; nine\nPAPERS and 10 big dailies too.", "Seven or more papers, a hundred newspapers, 3papers.", "", "Eight two papers; 4 of the dailies.")


@query("x24_claimed_sources", rf"""with {_planted_sql(CLAIMS)},
found as (select doc_id, regexp_extract_all(t, '(?i)(?:^|\W)(\d+|two|three|four|five|six|seven|eight|nine|ten)\s+(?:\w+\s+)?(?:newspapers|papers|dailies|outlets)(?:\W|$)', 1) as n from said)
select doc_id, [coalesce(try_cast(x as bigint), list_position(['', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten'], lower(x))) for x in n] as claimed from found""")
def x24(spark, d):
    return _with_planted(spark, d, CLAIMS).select("doc_id", F.transform(text.claimed_sources(F.col("said"), "en"), lambda x: x.cast("long")).alias("claimed"))


@query("x25_opening_sentence", r"select doc_id, case when regexp_matches(t, '(?s)^.+?[.!?](\s|$)') then regexp_extract(t, '(?s)^(.+?[.!?])(\s|$)', 1) else left(t, 300) end as opening from (select doc_id, replace(trim(text), 'U.S.', 'US') as t from documents)")
def x25(spark, d):
    return docs(spark, d).select("doc_id", text.opening_sentence(F.col("text")).alias("opening"))


@query("x27_same_country_groups", "select n_name, list_sort(list(s_name)) as names from supplier join nation on n_nationkey = s_nationkey where n_name != 'FRANCE' group by 1 having count(*) >= 2")
def x27(spark, d):
    s = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("n_nationkey") == F.col("s_nationkey")).where("n_name != 'FRANCE'")
    return s.groupBy("n_name").agg(F.array_sort(F.collect_set("s_name")).alias("names")).where(F.size("names") >= 2)


@query("x26_origin_groups", r"""
with t as (select doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{M}\p{N}_''’-]+')) as w, generate_subscripts(regexp_extract_all(text, '[\p{L}\p{M}\p{N}_''’-]+'), 1) as i from documents),
o as (select doc_id, i, lower(w) as w from t where lower(w) in ('the', 'and', 'of')), n as (select doc_id, i from t where regexp_matches(w, '(?i)that|with|is')),
near as (select distinct o.doc_id, o.w from o join (select doc_id, i - unnest([1, 2, 3, 4, 5]) as i from n) m using (doc_id, i))
select documents.doc_id, coalesce(list_sort(list(w) filter (where w is not null)), []) as origins from documents left join near using (doc_id) group by 1""")
def x26(spark, d):
    # the rule on words that the invented prose has
    found = framing.origin_groups(F.col("text"), {"the": ["=the"], "and": ["=and"], "of": ["=of"]}, {}, ["that", "with", "is"])
    return docs(spark, d).select("doc_id", found.alias("origins"))


PAPERS = {"The Guardian": "UK", "The Daily Telegraph": "UK", "Los Angeles Times": "US", "The Washington Post": "US", "Süddeutsche Zeitung": "Germany", "Neue Zürcher Zeitung": "Switzerland", "The Economist": "International"}
OPENINGS = (
    "Coverage splits between the British press and German outlets.", "The papers differ less along national lines than over tone.", "Coverage divides along national lines.",
    "The British government and the American one differ.", "US media contrast with Swiss commentary. British papers agree.", "British and American press do not differ.",
)


@query("x26_national_framing", rf"""with {_planted_sql(OPENINGS)},
opened as (select doc_id, lower(case when regexp_matches(f, '(?s)^.+?[.!?](\s|$)') then regexp_extract(f, '(?s)^(.+?[.!?])(\s|$)', 1) else left(f, 300) end) as s from (select doc_id, replace(trim(t), 'U.S.', 'US') as f from said)),
told as (select *, regexp_matches(s, '(^|\W)(less|not)(\W|$)') as negated, len([o for o in ['british', 'american', 'german', 'swiss', '(^|\W)us'] if regexp_matches(s, o || '[a-z]*([^a-z]+[a-z]+){{0,4}}[^a-z]+[a-z]*(press|media|outlet|commentary)')]) as origins from opened)
select doc_id, not negated and (regexp_matches(s, '(^|\W)(along )?national lines') or origins >= 2 and regexp_matches(s, 'split|differ|contrast|between')) as framed from told""")
def x26_framing(spark, d):
    return _with_planted(spark, d, OPENINGS).select("doc_id", framing.frames_by_nationality(F.col("said"), "en").alias("framed"))


LISTS = (
    "American papers - The Guardian, Los Angeles Times and The Washington Post - agree.", "British papers such as The Guardian and The Daily Telegraph agree.", "German newspapers, especially Neue Zürcher Zeitung and The Economist.", "",
    "The leading British outlets: Los Angeles Times, Süddeutsche Zeitung and The Guardian.", "British papers agree with The Washington Post.", "american outlets covering all of it - the Süddeutsche Zeitung.",
)
_NAMES_SQL = "The Guardian|The Daily Telegraph|Los Angeles Times|The Washington Post|Süddeutsche Zeitung|Neue Zürcher Zeitung|The Economist"


@query("x28_nationality_labels", rf"""with {_planted_sql(LISTS)},
lists as (select doc_id, regexp_extract(t, '(?i:(american|british|german) (papers|newspapers|outlets))(?: [a-z]+)*?(?: - | such as |, especially |: )(?:the )?((?:(?:{_NAMES_SQL})(?:, | and )?)+)', ['origin', 'noun', 'names']) as m from said),
wrong as (select doc_id, m.origin || ' ' || m.noun as label, [n for n in regexp_extract_all(m.names, '{_NAMES_SQL}') if n != 'The Economist' and not list_contains(case lower(m.origin) when 'american' then ['Los Angeles Times', 'The Washington Post']
    when 'british' then ['The Guardian', 'The Daily Telegraph'] else ['Süddeutsche Zeitung', 'Neue Zürcher Zeitung'] end, n)] as w from lists)
select doc_id, case when len(w) > 0 then [label || ': ' || array_to_string(w, ', ')] else [] end as conflicts from wrong""")
def x28(spark, d):
    found = _with_planted(spark, d, LISTS).select("doc_id", framing.nationality_conflicts(PAPERS, "en")("said").alias("found"))
    return found.select("doc_id", F.transform("found", lambda c: F.concat(c["label"], F.lit(": "), F.array_join(c["wrong"], ", "))).alias("conflicts"))


@query("x29_section_audit", r"""
with t as (select doc_id, lang, case doc_id % 5 when 0 then 'Four newspapers report. ' when 1 then 'British papers such as Los Angeles Times agree. ' when 2 then 'Coverage divides along national lines. ' else '' end || coalesce(text, '') as text from documents),
f as (
    select doc_id, 'foreign_chars' as kind from t where regexp_matches(text, '[^\x00-\x7FÀ-ÿ]')
    union all select doc_id, 'mixed_script' from t where len([w for w in regexp_extract_all(text, '[\p{L}\p{M}]+') if regexp_matches(w, '[éè]') and regexp_matches(w, '[A-Z]')]) > 0
    union all select doc_id, 'tag_fragment' from t where regexp_matches(text, '</?[A-Za-z_]')
    union all select doc_id, 'low_script_ratio' from t where lang = 'en' and length(regexp_replace(text, '[^\p{L}]', '', 'g')) >= 40 and length(regexp_replace(text, '[^a-m]', '', 'g')) / length(regexp_replace(text, '[^\p{L}]', '', 'g')) < 0.35
    union all select doc_id, 'name_tell' from t where contains(text, '!!') or contains(text, '###')
    union all select doc_id, 'digit_one' from t where regexp_matches(text, '[a-z]-1[ \x{00A0}][A-Z]|[a-z][ \x{00A0}]1-[A-Z]')
    union all select doc_id, 'paper_count' from t where doc_id % 5 = 0
    union all select doc_id, 'nationality' from t where doc_id % 5 = 1
    union all select doc_id, 'framing' from t where doc_id % 5 = 2)
select doc_id, kind, case when kind = 'framing' then '' else 'said' end as field from f""")
def x29(spark, d):
    # every fifth text has a sentence before it that one of the last three checks finds
    first = F.when(F.col("doc_id") % 5 == 0, "Four newspapers report. ").when(F.col("doc_id") % 5 == 1, "British papers such as Los Angeles Times agree. ").when(F.col("doc_id") % 5 == 2, "Coverage divides along national lines. ").otherwise("")
    sections = docs(spark, d).select("doc_id", "lang", F.concat(first, F.coalesce("text", F.lit(""))).alias("said"))
    papers = F.array(F.lit("The Guardian"), F.lit("The Daily Telegraph"))
    flags = audit.section_flags(sections, "doc_id", {"said": "en"}, papers, PAPERS, ALLOWED, ("[éè]", "[A-Z]"), {"en": "a-m"}, {"en": ["!!", "###"]}, ["en"], F.col("lang") == "en")
    return flags.select("doc_id", "kind", "field")


WEDGED = ("Herr Brandt-1 Smith wrote.", "the B-1 bomber and 11-Smith", "Brandt and Smith", "Brandt\u00a01-Smith agree", "a1-B 1- B -1")


@query("x30_one_for_and", rf"with {_planted_sql(WEDGED)} select doc_id, regexp_matches(t, '[a-z](-1[ \x{{00A0}}]|[ \x{{00A0}}]1-)[A-Z]') as wrong from said")
def x30(spark, d):
    return _with_planted(spark, d, WEDGED).select("doc_id", text.one_for_and(F.col("said")).alias("wrong"))


@query("x31_word_set", r"select conv_id, turn, list_sort(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{3,}'))) as words from conversations")
def x31(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", text.word_set(F.col("text")).alias("words"))


@query("x32_excerpt", "select d.doc_id, b.item_id from documents d, benchmark b where contains(d.text, b.text)")
def x32(spark, d):
    return excerpts.passages_found(docs(spark, d), "doc_id", "text", table(spark, d, "benchmark"), "item_id", "text")


@query("x32_excerpt_checks", rf"""
with i as (select conv_id, turn, array_to_string(string_split({SQUEEZED}, ' ')[3:10], ' ') as excerpt, role as author from conversations),
w as (select i.*, array_to_string(regexp_extract_all(lower(c.text), '[\p{{L}}\p{{M}}\p{{N}}_]+'), ' ') as page, array_to_string(regexp_extract_all(lower(excerpt), '[\p{{L}}\p{{M}}\p{{N}}_]+'), ' ') as own,
    list_distinct(regexp_extract_all(lower(c.text), '[\p{{L}}\p{{N}}_]{{3,}}')) as page_words, list_distinct(regexp_extract_all(lower(excerpt), '[\p{{L}}\p{{N}}_]{{3,}}')) as words
    from i join conversations c on c.conv_id = i.conv_id and c.turn = i.turn - i.turn % 2)
select conv_id, turn, trim(excerpt) != '' and contains(page, own) as verbatim, trim(excerpt) != '' and len(list_intersect(words, page_words)) >= 0.9 * greatest(len(words), 1) as mostly,
    not list_contains(page_words, lower(author)) as author_missing from w""")
def x32_checks(spark, d):
    # every second turn's excerpt is held against the turn before
    c = table(spark, d, "conversations")
    excerpt = F.array_join(F.slice(F.split(text.squeezed(F.col("text")), " "), 3, 8), " ")
    items = c.select("conv_id", "turn", (F.col("turn") - F.col("turn") % 2).alias("page"), excerpt.alias("excerpt"), F.col("role").alias("author"))
    pages = c.select("conv_id", F.col("turn").alias("page"), "text")
    return excerpts.excerpt_checks(items, pages, ["conv_id", "page"], "excerpt", "author", "text").select("conv_id", "turn", "verbatim", "mostly", "author_missing")


@query("x33_sequence_ratio")
def x33(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("t"))
    following = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("t").alias("next"))
    return c.join(following, ["conv_id", "turn"]).select("conv_id", "turn", F.round(scores.sequence_ratio("t", "next"), 6).alias("ratio"))


@query("x34_content_key", "select doc_id, left(sha256('[\"' || lang || '\",\"' || source || '\"]'), 16) as key from documents")
def x34(spark, d):
    return docs(spark, d).select("doc_id", text.content_key(F.col("lang"), F.col("source")).alias("key"))


@query("x35_html_escape", "select page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) as escaped from pages")
def x35(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(text.html_escaped(F.col("html"))).alias("escaped"))


@query("x36_custom_ids", "select conv_id, turn, 'p' || conv_id || '_' || turn as id, conv_id as parsed from conversations")
def x36(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.format_string("p%d_%d", "conv_id", "turn").alias("id"))
    return c.withColumn("parsed", F.regexp_extract("id", r"^p(\d+)_(\d+)$", 1).cast("long"))


@query("x37_labels", "select n_name, coalesce(case n_name when 'FRANCE' then 'Frankreich' when 'GERMANY' then 'Deutschland' end, n_name) as label from nation")
def x37(spark, d):
    names = F.create_map(*map(F.lit, ("FRANCE", "Frankreich", "GERMANY", "Deutschland")))
    return table(spark, d, "nation").select("n_name", F.coalesce(F.try_element_at(names, F.col("n_name")), F.col("n_name")).alias("label"))
