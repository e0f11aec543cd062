"""Which language a text is written in, from script and function words, and which one a request asks for."""

from __future__ import annotations

import regex

# Function words by language. Words that two of the languages share are left out.
FUNCTION_WORDS = {
    "en": "the and of to is are was were with that this for from by on at it its be been has have had not but which when what who "
    "will would can should could may before after while because since any each every both two one then so than there you your "
    "i my we our they he she do does did into only nothing else now whatever next find keep if unless although until",
    "de": "der die das den dem des und ist sind war wurde wurden mit von zu zum zur auf aus bei nach für nicht auch aber oder wenn "
    "danach soll sollen muss müssen kann ich wir sie ihr mein bitte noch vor nun am im ein eine einen einem einer dass hat habe "
    "haben über unter dabei leid tut mir fragen diese dieser leider darf standen steigt werden",
    "es": "el la los las del y que por para con sin una unos unas se es son fue fueron está están hay como más pero su sus al lo ya "
    "cuando desde hasta sobre hace falta puede antes después tiene debo puedo siento quedó vieron porque si mi este esta eso",
}
_SETS = {lang: frozenset(ws.split()) for lang, ws in FUNCTION_WORDS.items()}
_CODE = regex.compile(r"(?s)```.*?(?:```|$)|<tool_call>.*?(?:</tool_call>|$)|<tool_result[^>]*>.*?(?:</tool_result>|$)|`[^`\n]*`|</?[\w-]+[^<>]*>")
_NAMES = regex.compile(r"[\w.@-]*[/_\\][\w./\\-]*|\b[A-Za-z]+-[A-Za-z-]+\b|\b\w+\.\w+\b|[\w.-]*\d[\w.-]*", regex.ASCII)
_HAN, _LATIN = regex.compile(r"\p{Han}"), regex.compile(r"\p{Latin}+(?:'\p{Latin}+)?")
_KANA, _OTHER = regex.compile(r"[\p{Hiragana}\p{Katakana}]"), regex.compile(r"[\p{Cyrillic}\p{Arabic}\p{Hangul}\p{Greek}\p{Hebrew}\p{Thai}\p{Devanagari}]")

# Names of languages as requests in the four languages write them.
LANGUAGE_NAMES = {
    "en": "english englisch englischer inglés ingles 英文 英语 英語".split(),
    "zh": "chinese mandarin chinesisch chinesischer chino 中文 汉语 漢語".split(),
    "de": "german deutsch deutscher alemán aleman 德文 德语 德語".split(),
    "es": "spanish spanisch spanischer español espanol castellano 西班牙文 西班牙语 西班牙語".split(),
}
_BY_NAME = {n: lang for lang, names in LANGUAGE_NAMES.items() for n in names}
_NAME = "|".join(sorted(_BY_NAME, key=len, reverse=True))
_ASKED = regex.compile(
    rf"(?i)\b(?:answer|reply|respond|response|write|written|antwort\w*|schreib\w*|respond[ea]\w*|contest[ea]\w*|escrib[ea]\w*|respuesta)\b[^.!?\n]{{0,40}}?\b(?:in|auf|en)\s+({_NAME})\b"
    rf"|(?:用|使用|以)\s*({_NAME})|({_NAME})\s*(?:回答|回复|作答|答复)"
)


def prose(text: str) -> str:
    """`text` without code, tool calls, tags, paths and identifiers."""
    return _NAMES.sub(" ", _CODE.sub(" ", text))


def language(text: str) -> str | None:
    """en, de, es, zh, other, or None where the prose is too short to tell."""
    p = prose(text)
    han, latin = len(_HAN.findall(p)), _LATIN.findall(p.lower())
    if _KANA.search(p) and len(_KANA.findall(p)) > 2 or len(_OTHER.findall(p)) > max(3, sum(map(len, latin)) // 2):
        return "other"
    if han >= 2 and han * 2 >= len(latin):
        return "zh"
    hits = {lang: sum(w in ws for w in latin) for lang, ws in _SETS.items()}
    best = max(hits, key=lambda k: hits[k])
    if hits[best] == 0 or sorted(hits.values())[-2] * 3 > hits[best] * 2:
        return None
    return best


def asked_language(request: str) -> str | None:
    """The language that a request asks its answer to be in, the last one if it names several."""
    found = _ASKED.findall(request)
    return _BY_NAME[next(x for x in found[-1] if x).lower()] if found else None
