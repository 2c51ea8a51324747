"""English suffix stripping after Porter's published "Porter2" description."""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc

# Fixed values of the published algorithm.
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
R1_PREFIXES = ("gener", "commun", "arsen")
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
STOP_AFTER_PLURAL = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous",
    "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
STEP3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "", "ative": "",
}
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ism", "ate", "iti", "ous", "ive", "ize", "ion",
)

_REGION = re.compile(f"[{VOWELS}][^{VOWELS}]")
_HAS_VOWEL = re.compile(f"[{VOWELS}]")
_SHORT_END = re.compile(f"(?:[^{VOWELS}][{VOWELS}][^{VOWELS}wxY]|^[{VOWELS}][^{VOWELS}])$")


def _region_start(word: str, begin: int) -> int:
    m = _REGION.search(word, begin)
    return m.end() if m else len(word)


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def stem_word(word: str) -> str:
    """Stem of one lower-case word; other words come back unchanged."""
    if len(word) <= 2:
        return word
    if word in WHOLE_WORDS:
        return WHOLE_WORDS[word]
    w = word.removeprefix("'")
    w = re.sub(f"^y|(?<=[{VOWELS}])y", "Y", w)
    prefix = next((p for p in R1_PREFIXES if w.startswith(p)), None)
    r1 = len(prefix) if prefix else _region_start(w, 0)
    r2 = _region_start(w, r1)

    cut = _longest(w, ("'s'", "'s", "'"))
    if cut:
        w = w[: -len(cut)]

    # Plurals.
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and _HAS_VOWEL.search(w[:-2]):
        w = w[:-1]
    if w in STOP_AFTER_PLURAL:
        return w

    # Past and progressive forms.
    end = _longest(w, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if end in ("eed", "eedly"):
        if len(w) - len(end) >= r1:
            w = w[: -len(end)] + "ee"
    elif end and _HAS_VOWEL.search(w[: -len(end)]):
        w = w[: -len(end)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w.endswith(DOUBLES):
            w = w[:-1]
        elif len(w) <= r1 and _SHORT_END.search(w):
            w += "e"

    if len(w) > 2 and w[-1] in "yY" and w[-2] not in VOWELS:
        w = w[:-1] + "i"

    # Longer suffixes, inside the first region.
    end = _longest(w, STEP2)
    if end and len(w) - len(end) >= r1:
        before = w[-len(end) - 1 : -len(end)]
        if (end != "ogi" or before == "l") and (end != "li" or (before and before in LI_ENDINGS)):
            w = w[: -len(end)] + STEP2[end]
    end = _longest(w, STEP3)
    if end and len(w) - len(end) >= (r2 if end == "ative" else r1):
        w = w[: -len(end)] + STEP3[end]

    # Suffixes dropped inside the second region.
    end = _longest(w, STEP4)
    if end and len(w) - len(end) >= r2 and (end != "ion" or w[:-3].endswith(("s", "t"))):
        w = w[: -len(end)]

    if w.endswith("e"):
        at = len(w) - 1
        if at >= r2 or (at >= r1 and not _SHORT_END.search(w[:-1])):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.replace("Y", "y")


_stems: dict[str, str] = {}
_STEMS_KEPT = 1 << 18


def _stem(word: str | None) -> str | None:
    if word is None:
        return None
    found = _stems.get(word)
    if found is None:
        if len(_stems) >= _STEMS_KEPT:
            _stems.clear()
        found = _stems[word] = stem_word(word)
    return found


def stem_arrays(tokens: pa.Array) -> pa.Array:
    """Stem a batch of token arrays: only its distinct words are looked at, the rest is a dictionary lookup."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0)
    words = tokens.flatten().cast(pa.string()).dictionary_encode()
    stems = pa.array([_stem(w) for w in words.dictionary.to_pylist()], pa.string()).take(words.indices)
    offsets = pc.cumulative_sum(pa.concat_arrays([pa.array([0], pa.int32()), sizes.cast(pa.int32())]))
    return pa.ListArray.from_arrays(offsets, stems, mask=pc.is_null(tokens))
