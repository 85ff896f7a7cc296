"""Public suffixes of more than one label under which unrelated owners register names.

A part of the Public Suffix List (publicsuffix.org): the registry suffixes of widely used country codes. A host under none of them
has its last label as its suffix; wildcard and exception rules, and suffixes of private hosting services, are not in it.
"""

_BY_COUNTRY = {
    "ar": "com edu gob gov int mil net org", "at": "ac co gv or", "au": "asn com edu gov id net org", "bd": "com edu gov net org",
    "br": "adv art blog com edu eng gov ind inf jus leg mil net org tv", "cn": "ac com edu gov mil net org", "co": "com edu gov mil net nom org",
    "cy": "ac com gov net org", "eg": "com edu gov net org", "es": "com edu gob nom org", "gr": "com edu gov net org", "hk": "com edu gov idv net org",
    "hu": "co info org", "id": "ac co desa go mil net or sch web", "il": "ac co gov idf k12 muni net org", "in": "ac co edu firm gen gov ind mil net nic org res",
    "it": "edu gov", "jp": "ac ad co ed go gr lg ne or", "ke": "ac co go info me mobi ne or sc", "kr": "ac co es go hs kg mil ms ne or pe re sc",
    "ma": "ac co gov net org press", "mx": "com edu gob net org", "my": "com edu gov mil name net org", "ng": "com edu gov mil net org sch",
    "nz": "ac co cri geek gen govt health iwi kiwi maori mil net org parliament school", "pe": "com edu gob mil net nom org",
    "ph": "com edu gov mil net ngo org", "pk": "com edu gov net org", "pl": "com edu gov info net org", "pt": "com edu gov int net nome org publ",
    "ro": "com info nom org store", "rs": "ac co edu gov in org", "ru": "ac edu gov int mil", "sa": "com edu gov med net org sch",
    "sg": "com edu gov net org per", "th": "ac co go in mi net or", "tr": "av bbs bel biz com dr edu gen gov info k12 mil name net org pol tel tv web",
    "tw": "com edu gov idv mil net org", "tz": "ac co go or sc", "ua": "com edu gov in net org", "ug": "ac co com go ne or org sc",
    "uk": "ac co gov ltd me net nhs org plc police sch", "uy": "com edu gub mil net org", "ve": "co com edu gob info net org web",
    "vn": "ac com edu gov health info int name net org", "za": "ac co edu gov law mil net nom org school web",
}
SUFFIXES = tuple(f"{name}.{country}" for country, names in _BY_COUNTRY.items() for name in names.split()) + tuple(
    f"{s}.edu.au" for s in "act catholic nsw nt qld sa tas vic wa".split()
)
