"""Checks over finished sections: a row for each flag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import framing
from tidemark.functions import text as rules


def section_flags(
    sections: DataFrame, key: str, fields: Mapping[str, str], papers: Column, country_of: Mapping[str, str], allowed: str, scripts: tuple[str, ...],
    expected: Mapping[str, str] | None = None, tells: Mapping[str, Sequence[str]] | None = None, garbled: Sequence[str] = (), judged: Column | None = None,
) -> DataFrame:
    """key, kind, field, detail of every flag.

    fields are columns of text with their language; papers the array of papers that a section draws on. Kinds: foreign_chars, mixed_script and tag_fragment in
    any field; low_script_ratio in fields of a language with an expected script, if the section is judged; name_tell for names written as in tells, by language;
    digit_one between names in the languages of garbled; paper_count where a text claims more papers than there are, up to what the list of papers could hold;
    nationality where a list of papers belies the label before it; framing where an opening divides papers by country that are from the same one.
    """
    real = F.size(F.array_distinct(F.array_compact(papers)))
    none = F.array().cast("array<struct<kind:string,field:string,detail:string>>")
    flag = lambda kind, field, detail, when: F.when(when, F.array(F.struct(F.lit(kind).alias("kind"), F.lit(field).alias("field"), detail.alias("detail")))).otherwise(none)
    joined = lambda found: F.array_join(found.cast("array<string>"), ", ")
    flags = []
    for field, lang in fields.items():
        said, defects = F.col(field), F.col(f"_defects_{field}")
        for kind in rules.DEFECTS:
            found = F.try_element_at(defects, F.lit(kind))
            shown = found.isNotNull() & (judged if kind == "low_script_ratio" and judged is not None else F.lit(True))
            flags.append(flag(kind, field, joined(found), shown))
        if (tells or {}).get(lang):
            found = F.col(f"_tells_{field}")
            flags.append(flag("name_tell", field, joined(found), F.size(found) > 0))
        if lang in garbled:
            flags.append(flag("digit_one", field, F.lit(""), rules.one_for_and(said)))
        claims = F.filter(F.col(f"_claims_{field}"), lambda n: (n > real) & (n <= rules.MOST_SOURCES))
        flags.append(flag("paper_count", field, joined(claims), F.size(claims) > 0))
        wrong = F.col(f"_wrong_{field}")
        flags.append(flag("nationality", field, F.array_join(F.transform(wrong, lambda w: F.concat(w["label"], F.lit(": "), F.array_join(w["wrong"], ", "))), "; "), F.size(wrong) > 0))
    framed = framing.framing_conflict({lang: F.col(f) for f, lang in fields.items()}, papers, country_of)
    flags.append(flag("framing", "", joined(framed), F.size(framed) > 0))
    checked = sections.withColumns({f"_wrong_{f}": framing.nationality_conflicts(country_of, lang)(f) for f, lang in fields.items()})
    checked = checked.withColumns({f"_defects_{f}": rules.text_defects(F.col(f), allowed, scripts, (expected or {}).get(lang)) for f, lang in fields.items()})
    checked = checked.withColumns({f"_claims_{f}": rules.claimed_sources(F.col(f), lang) for f, lang in fields.items()})
    checked = checked.withColumns({f"_tells_{f}": rules.tells(F.col(f), (tells or {}).get(lang, ())) for f, lang in fields.items() if (tells or {}).get(lang)})
    return checked.select(key, F.explode(F.flatten(F.array(*flags))).alias("_f")).select(key, "_f.kind", "_f.field", "_f.detail")
