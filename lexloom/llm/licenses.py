"""License detection: ordered rules behind a keyword filter; overlapping detections are resolved by priority and containment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import textcore as tc

# The phrases and labels of the contract.
BASE = {"the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Label, SPDX identifier, keyword, pattern of the name, pattern of an address. Texts are in lower case; a space stands for any run of white space.
# A keyword's words are in whatever the name's pattern matches; | parts alternatives.
LICENSES = (
    ("mit", "mit", "mit", r"(?:the )?mit(?: |-)licen[sc]e|mit/x11", r"opensource\.org/licenses/mit"),
    ("mit-0", "mit-0", "attribution", r"mit no attribution", r"opensource\.org/licenses/mit-0"),
    ("apache-2", "apache-2.0", "apache", r"apache(?: software)?(?: |-)licen[sc]e,? ?(?:version |v)?2(?:\.0)?(?!\.?\d)|apache(?: |-)(?:version |v)?2(?:\.0)? licen[sc]e", r"apache\.org/licenses/license-2\.0"),
    ("apache-1.1", "apache-1.1", "apache", r"apache(?: software)? licen[sc]e,? (?:version |v)?1\.1", r"apache\.org/licenses/license-1\.1"),
    ("gpl-1.0", "gpl-1.0-only", "general", r"(?<!lesser\s)(?<!affero\s)(?<!library\s)general public licen[sc]e,? (?:version |v)1", r"gnu\.org/licenses/(?:old-licenses/)?gpl-1"),
    ("gpl-2.0", "gpl-2.0-only", "general", r"(?<!lesser\s)(?<!affero\s)(?<!library\s)general public licen[sc]e,? (?:as published by the free software foundation[;,] ?(?:either )?)?(?:version |v)2", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2"),
    ("gpl-3.0", "gpl-3.0-only", "general", r"(?<!lesser\s)(?<!affero\s)(?<!library\s)general public licen[sc]e,? (?:as published by the free software foundation[;,] ?(?:either )?)?(?:version |v)3", r"gnu\.org/licenses/gpl-3"),
    ("lgpl-2.0", "lgpl-2.0-only", "library", r"library general public licen[sc]e,? (?:version |v)2", r"gnu\.org/licenses/old-licenses/lgpl-2\.0"),
    ("lgpl-2.1", "lgpl-2.1-only", "lesser", r"lesser general public licen[sc]e,? (?:version |v)2\.1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", "lgpl-3.0-only", "lesser", r"lesser general public licen[sc]e,? (?:version |v)3", r"gnu\.org/licenses/lgpl-3"),
    ("agpl-3.0", "agpl-3.0-only", "affero", r"affero general public licen[sc]e,? (?:version |v)3", r"gnu\.org/licenses/agpl-3"),
    ("gfdl-1.3", "gfdl-1.3-only", "free documentation", r"free documentation licen[sc]e,? (?:version |v)1\.3", r"gnu\.org/licenses/fdl-1\.3"),
    ("bsd-2-clause", "bsd-2-clause", "bsd", r"(?:simplified |freebsd |2-clause |two-clause )bsd licen[sc]e|bsd (?:2|two)[- ]clause", r"opensource\.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", "bsd-3-clause", "bsd", r"(?:new |modified |revised |3-clause |three-clause )bsd licen[sc]e|bsd (?:3|three)[- ]clause", r"opensource\.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", "bsd-4-clause", "bsd", r"(?:original |4-clause |four-clause )bsd licen[sc]e|bsd (?:4|four)[- ]clause", r"spdx\.org/licenses/bsd-4-clause"),
    ("0bsd", "0bsd", "bsd", r"zero[- ]clause bsd|bsd zero[- ]clause", r"opensource\.org/licenses/0bsd"),
    ("isc", "isc", "isc", r"isc licen[sc]e", r"opensource\.org/licenses/isc"),
    ("mpl-1.1", "mpl-1.1", "mozilla", r"mozilla public licen[sc]e,? (?:version |v)?1\.1", r"mozilla\.org/mpl/1\.1"),
    ("mpl-2.0", "mpl-2.0", "mozilla", r"mozilla public licen[sc]e,? (?:version |v)?2", r"mozilla\.org/mpl/2\.0"),
    ("epl-1.0", "epl-1.0", "eclipse", r"eclipse public licen[sc]e(?: -)?,? (?:version |v)?1", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", "epl-2.0", "eclipse", r"eclipse public licen[sc]e(?: -)?,? (?:version |v)?2", r"eclipse\.org/legal/epl-(?:v20|2\.0)"),
    ("cddl-1.0", "cddl-1.0", "common development", r"common development and distribution licen[sc]e", r"opensource\.org/licenses/cddl"),
    ("cpl-1.0", "cpl-1.0", "common public", r"common public licen[sc]e", r"opensource\.org/licenses/cpl"),
    ("eupl-1.1", "eupl-1.1", "european union", r"european union public licen[sc]e,? (?:version |v)?1\.1", r"eupl-1\.1"),
    ("eupl-1.2", "eupl-1.2", "european union", r"european union public licen[sc]e,? (?:version |v)?1\.2", r"eupl-1\.2"),
    ("bsl-1.0", "bsl-1.0", "boost", r"boost software licen[sc]e", r"boost\.org/license_1_0"),
    ("zlib", "zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e", r"zlib\.net/zlib_license"),
    ("unlicense", "unlicense", "unlicense", r"the unlicense", r"unlicense\.org"),
    ("wtfpl", "wtfpl", "wtfpl|what want", r"do what the f\S+ you want to public licen[sc]e|wtfpl", r"wtfpl\.net"),
    ("artistic-1.0", "artistic-1.0", "artistic", r"artistic licen[sc]e,? (?:version |v)?1", r"opensource\.org/licenses/artistic-1"),
    ("artistic-2.0", "artistic-2.0", "artistic", r"artistic licen[sc]e,? (?:version |v)?2", r"opensource\.org/licenses/artistic-2"),
    ("python-2.0", "python-2.0", "python|psf", r"python software foundation licen[sc]e|psf licen[sc]e", r"docs\.python\.org/\S*license"),
    ("php-3.01", "php-3.01", "php", r"php licen[sc]e,? (?:version |v)?3\.01", r"php\.net/license"),
    ("ruby", "ruby", "ruby", r"ruby licen[sc]e", r"ruby-lang\.org/\S*license"),
    ("postgresql", "postgresql", "postgresql", r"postgresql licen[sc]e", r"postgresql\.org/about/licence"),
    ("openssl", "openssl", "openssl", r"openssl licen[sc]e", r"openssl\.org/source/license"),
    ("ms-pl", "ms-pl", "microsoft", r"microsoft public licen[sc]e", r"opensource\.org/licenses/ms-pl"),
    ("ms-rl", "ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", r"opensource\.org/licenses/ms-rl"),
    ("ofl-1.1", "ofl-1.1", "open font", r"(?:sil )?open font licen[sc]e", r"scripts\.sil\.org/ofl"),
    ("upl-1.0", "upl-1.0", "universal permissive", r"universal permissive licen[sc]e", r"opensource\.org/licenses/upl"),
    ("ncsa", "ncsa", "ncsa", r"(?:university of illinois/)?ncsa open source licen[sc]e", r"opensource\.org/licenses/ncsa"),
    ("osl-3.0", "osl-3.0", "open software", r"open software licen[sc]e,? (?:version |v)?3", r"opensource\.org/licenses/osl-3"),
    ("afl-3.0", "afl-3.0", "academic free", r"academic free licen[sc]e,? (?:version |v)?3", r"opensource\.org/licenses/afl-3"),
    ("busl-1.1", "busl-1.1", "business source", r"business source licen[sc]e", r"mariadb\.com/bsl11"),
    ("sspl-1.0", "sspl-1.0", "server side", r"server side public licen[sc]e", r"mongodb\.com/licensing/server-side-public-license"),
    ("elastic-2.0", "elastic-2.0", "elastic", r"elastic licen[sc]e,? (?:version |v)?2", r"elastic\.co/licensing/elastic-license"),
    ("odbl-1.0", "odbl-1.0", "open database", r"open database licen[sc]e", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", "odc-by-1.0", "open data commons", r"open data commons attribution licen[sc]e", r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", "pddl-1.0", "public domain dedication", r"public domain dedication (?:and|&) licen[sc]e", r"opendatacommons\.org/licenses/pddl"),
    ("apache-1.0", "apache-1.0", "apache", r"apache(?: software)? licen[sc]e,? (?:version |v)?1\.0", r"apache\.org/licenses/license-1\.0"),
    ("apsl-2.0", "apsl-2.0", "apple public", r"apple public source licen[sc]e,? (?:version |v)?2", r"opensource\.apple\.com/license/apsl"),
    ("bsd-3-clause-clear", "bsd-3-clause-clear", "clear bsd", r"clear bsd licen[sc]e", r"spdx\.org/licenses/bsd-3-clause-clear"),
    ("blueoak-1.0.0", "blueoak-1.0.0", "blue oak", r"blue oak model licen[sc]e", r"blueoakcouncil\.org/license/1\.0\.0"),
    ("cecill-2.1", "cecill-2.1", "cecill", r"cecill(?: free software)?(?: licen[sc]e)?(?: agreement)?,? (?:version |v)?2\.1", r"cecill\.info/licences/licence_cecill_v2\.1"),
    ("cecill-b", "cecill-b", "cecill-b", r"cecill-b(?: licen[sc]e)?", r"cecill\.info/licences/licence_cecill-b"),
    ("cecill-c", "cecill-c", "cecill-c", r"cecill-c(?: licen[sc]e)?", r"cecill\.info/licences/licence_cecill-c"),
    ("cpal-1.0", "cpal-1.0", "common public attribution", r"common public attribution licen[sc]e", r"opensource\.org/licenses/cpal_1\.0"),
    ("curl", "curl", "curl", r"curl licen[sc]e", r"curl\.se/docs/copyright"),
    ("ecl-2.0", "ecl-2.0", "educational community", r"educational community licen[sc]e", r"opensource\.org/licenses/ecl-2\.0"),
    ("efl-2.0", "efl-2.0", "eiffel forum", r"eiffel forum licen[sc]e", r"opensource\.org/licenses/efl-2\.0"),
    ("fair", "fair", "fair licen", r"the fair licen[sc]e", r"opensource\.org/licenses/fair"),
    ("ftl", "ftl", "freetype", r"freetype(?: project)? licen[sc]e", r"freetype\.org/license"),
    ("gfdl-1.2", "gfdl-1.2-only", "free documentation", r"free documentation licen[sc]e,? (?:version |v)1\.2", r"gnu\.org/licenses/(?:old-licenses/)?fdl-1\.2"),
    ("hippocratic-2.1", "hippocratic-2.1", "hippocratic", r"hippocratic licen[sc]e", r"firstdonoharm\.dev"),
    ("icu", "icu", "icu", r"icu licen[sc]e", r"unicode\.org/repos/icu/\S*license"),
    ("ijg", "ijg", "independent jpeg", r"independent jpeg group(?:'s)? licen[sc]e", r"ijg\.org"),
    ("imagemagick", "imagemagick", "imagemagick", r"imagemagick licen[sc]e", r"imagemagick\.org/script/license"),
    ("json", "json", "json", r"json licen[sc]e", r"json\.org/license"),
    ("latex", "lppl-1.3c", "latex project", r"latex project public licen[sc]e", r"latex-project\.org/lppl"),
    ("libpng", "libpng-2.0", "libpng", r"(?<!zlib/)libpng licen[sc]e", r"libpng\.org/pub/png/src/libpng-license"),
    ("lpl-1.02", "lpl-1.02", "lucent", r"lucent public licen[sc]e", r"opensource\.org/licenses/lpl-1\.02"),
    ("miros", "miros", "miros", r"miros licen[sc]e", r"opensource\.org/licenses/miros"),
    ("mulan-2.0", "mulanpsl-2.0", "mulan", r"mulan permissive software licen[sc]e", r"license\.coscl\.org\.cn/mulanpsl2"),
    ("nasa-1.3", "nasa-1.3", "nasa open", r"nasa open source agreement", r"opensource\.org/licenses/nasa1\.3"),
    ("npl-1.1", "npl-1.1", "netscape", r"netscape public licen[sc]e", r"mozilla\.org/mpl/npl/1\.1"),
    ("ntp", "ntp", "ntp", r"ntp licen[sc]e", r"opensource\.org/licenses/ntp"),
    ("ogl-uk-3.0", "ogl-uk-3.0", "open government", r"open government licen[sc]e,? (?:version |v)?3", r"nationalarchives\.gov\.uk/doc/open-government-licence/version/3"),
    ("oldap-2.8", "oldap-2.8", "openldap", r"openldap public licen[sc]e", r"openldap\.org/software/release/license"),
    ("qpl-1.0", "qpl-1.0", "q public", r"q public licen[sc]e", r"opensource\.org/licenses/qpl-1\.0"),
    ("rpl-1.5", "rpl-1.5", "reciprocal public", r"reciprocal public licen[sc]e", r"opensource\.org/licenses/rpl-1\.5"),
    ("simpl-2.0", "simpl-2.0", "simple public", r"simple public licen[sc]e", r"opensource\.org/licenses/simpl-2\.0"),
    ("sleepycat", "sleepycat", "sleepycat", r"sleepycat licen[sc]e", r"opensource\.org/licenses/sleepycat"),
    ("spl-1.0", "spl-1.0", "sun public", r"sun public licen[sc]e", r"opensource\.org/licenses/spl-1\.0"),
    ("tcl", "tcl", "tcl/tk", r"tcl/tk licen[sc]e", r"tcl-lang\.org/software/tcltk/license"),
    ("unicode-3.0", "unicode-3.0", "unicode", r"unicode licen[sc]e(?: v3)?", r"unicode\.org/license"),
    ("vim", "vim", "vim", r"vim licen[sc]e", r"vimhelp\.org/uganda"),
    ("w3c", "w3c", "w3c", r"w3c software(?: notice and)? licen[sc]e", r"w3\.org/consortium/legal/\S*software"),
    ("wxwindows", "wxwindows", "wxwindows", r"wxwindows(?: library)? licen[sc]e", r"opensource\.org/licenses/wxwindows"),
    ("zpl-2.1", "zpl-2.1", "zope", r"zope public licen[sc]e", r"opensource\.org/licenses/zpl-2\.1"),
    ("cc0-1.0", "cc0-1.0", "cc0", r"cc0(?: 1\.0)?(?: universal)?", r"creativecommons\.org/publicdomain/zero/1\.0"),
)
#: What names a licence in a notice of licence only: elsewhere it may be a program of that version.
SHORT = {"apache-2": r"apache(?: software)?,?(?: |-)?(?:version |v)?2(?:\.0)?(?!\.?\d)"}
_PARTS = {"by": "attribution", "nc": "non-?commercial", "nd": "no-?deriv(?:ative)?s?", "sa": "share-?alike"}
#: Creative Commons: every licence of every version.
CREATIVE = tuple(
    (f"cc-{kind}-{v}", f"cc-{kind}-{v}", f"cc {v}" if short else f"creative commons {v}", name, rf"creativecommons\.org/licenses/{kind}/{re.escape(v)}")
    for kind in ("by", "by-nc", "by-nc-nd", "by-nc-sa", "by-nd", "by-sa")
    for v in ("1.0", "2.0", "2.5", "3.0", "4.0")
    for short, name in ((True, rf"cc[ -]{'[ -]'.join(kind.split('-'))}[ -]{re.escape(v)}"), (False, rf"creative commons {'[ -]'.join(_PARTS[x] for x in kind.split('-'))} {re.escape(v)}"))
)
#: Ways to name a licence: pattern around an identifier, a name or an address; its priority and the score of a detection.
KINDS = (
    ("spdx", r"spdx-license-identifier: ?{id}(?![\w.-])", 4, 1.0),
    ("url", r"(?:https?://)?(?:www\.)?{url}", 3, 0.95),
    ("notice", r"(?:licen[sc]ed|released|distributed|available|published|provided) (?:\w+ ){{0,3}}?(?:under|by) (?:\w+ ){{0,4}}?(?:{name})", 2, 0.9),
    ("name", r"(?<![\w-])(?:{name})(?!\w)", 1, 0.7),
)


@dataclass(frozen=True)
class Rule:
    label: str
    kind: str
    priority: int
    score: float
    keyword: str
    pattern: re.Pattern


def literal(url: str) -> str:
    """The plain beginning of an address's pattern, which every match holds."""
    plain = re.match(r"(?:\\[^\w]|[\w/-])*", url)[0]
    return plain.replace("\\", "")


def rules() -> list[Rule]:
    """All rules in order: by priority, then as listed."""
    out: dict[tuple, Rule] = {}
    for kind, shape, priority, score in KINDS:
        for label, spdx, keyword, name, url in (*LICENSES, *CREATIVE):
            known = f"{name}|{SHORT[label]}" if kind == "notice" and label in SHORT else name
            text = shape.format(id=re.escape(spdx), url=url, name=known).replace("[- ]", "(?:-| )").replace("[ -]", "(?: |-)").replace(" ", r"[\s*#/]+")
            word = {"spdx": "spdx-license", "url": literal(url)}.get(kind, keyword)
            out.setdefault((label, kind, text), Rule(label, kind, priority, score, word, re.compile(text)))
    return list(out.values())


_WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_SEP = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_BASE = [(label, phrase.split()[1 if phrase.startswith("the") else 0], re.compile(rf"(?<![^\x00-\x2f\x3a-\x60\x7b-\x7f]){_SEP.join(phrase.split())}(?![^\x00-\x2f\x3a-\x60\x7b-\x7f])")) for phrase, label in BASE.items()]


def base_places(low: str) -> list[tuple[int, str]]:
    """(place of the character, label) of all places of the fixed phrases in text whose A-Z are lower-cased."""
    return sorted((m.start(), label) for label, word, pattern in _BASE if word in low for m in pattern.finditer(low))


def detect(low: str, all_rules: list[Rule]) -> list[tuple[int, int, str, float]]:
    """Detections (start, end, label, score) that stand: rules in their order, each detection unless one of at least its
    priority holds its interval. Of equal intervals the first rule's stands."""
    held = {k: any(all(w in low for w in part.split()) for part in k.split("|")) for k in {r.keyword for r in all_rules}}
    found = [(-r.priority, m.start() - m.end(), n, m.start(), m.end(), r) for n, r in enumerate(all_rules) if held[r.keyword] for m in r.pattern.finditer(low)]
    kept: list[tuple[int, int, str, float]] = []
    number = {a: i for i, a in enumerate(sorted({f[3] for f in found}), 1)}
    # A Fenwick tree over the starts: the farthest end of kept detections that start up to each of them.
    reach = [0] * (len(number) + 1)
    for _, _, _, a, b, r in sorted(found, key=lambda x: x[:3]):
        i, far = number[a], 0
        while i:
            far = max(far, reach[i])
            i &= i - 1
        if far >= b:
            continue
        kept.append((a, b, r.label, r.score))
        i = number[a]
        while i < len(reach):
            reach[i] = max(reach[i], b)
            i += i & -i
    return sorted(kept)


def _scan(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    all_rules = rules()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("score", pa.float64())]))
    for (ids,), texts in tc.batches(frames, "doc_id"):
        n_words = np.diff(tc.split(texts).first)
        rows: list[tuple] = []
        for text in texts:
            low = text.lower().decode(errors="replace")
            base, found = base_places(low), detect(low, all_rules)
            first = len(_WORD.findall(low, 0, base[0][0])) if base else None
            last = first + len(_WORD.findall(low, base[0][0], base[-1][0])) if base else None
            own = {label for _, label in base}
            score = max([1.0 * bool(base), *(f[3] for f in found)])
            rows.append((len(base), first, last, ",".join(sorted(own)), ",".join(sorted(own | {f[2] for f in found})), score, [dict(zip(("start", "end", "label", "score"), f, strict=True)) for f in found]))
        c = list(zip(*rows, strict=True))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), kind)
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), *(pa.array(x, t) for x, t in zip(c, types, strict=True))], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections (start, end, label, score).

    Base: every place where the words of a phrase of BASE stand consecutively. Beside it, hundreds of rules (each licence
    of LICENSES and CREATIVE as an SPDX tag, an address, a notice and a name) are tried, each only on texts that hold
    its keyword, words that all its matches hold. score is the best detection's, 1 with a base phrase, 0 without any. Null and empty texts have no words and
    no labels; repeated rows and null ids are kept; other columns are left out, whatever their names; an empty table gives an
    empty result. Nothing is shuffled.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(_scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<start:long,end:long,label:string,score:double>>")
