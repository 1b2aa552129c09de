"""op10: known licences among all documents.

The SQL twin has the digests and the patterns written down on its own, so that a slip in the module shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import licenses


def op10_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return licenses.scan(docs, "text").select("doc_id", "digest", "license", F.array_join("notices", ",").alias("notices"))


#: Licences and digests of the canonical forms of their texts and notices.
DIGESTS = [
    ("0BSD", "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"),
    ("0BSD", "9c842909bcc85365ba7f0d106fccdc3af51784431076174588a9832837ebf153"),
    ("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Apache-2.0", "28de6b6f31af692f3276f4c7d7f809bc7d39d3206a71fe090d61d943447aabc6"),
    ("Apache-2.0", "7a46cf4a5d56898d746584f4fe57bdf571d600a8f39d21063431d88929f803c7"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("BSD-2-Clause", "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2"),
    ("BSD-2-Clause", "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-3-Clause", "0974d0ab3b4deb9b6e21519293cacb68e85cd19414330602b34f54bba00cc156"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSD-3-Clause", "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af"),
    ("BSL-1.0", "4242941f56cc0aaf7a416006734167273b17a074704308b941e02a99526671b6"),
    ("BSL-1.0", "d74569b0dbb4e34ddb322196b65108cbcbb6a611548512c4ce4ab27c2670349a"),
    ("CC-BY-4.0", "5aee400278b51606c2353a854f7d936ffffe555bf9c67e56d5db376a76b63bb2"),
    ("CC-BY-NC-4.0", "e34399ae0e957e9bb9b4a0e3f615d05722861801f4e0718f35cefc762c349a16"),
    ("CC-BY-SA-4.0", "2b112a6fd54caf2eae8e23516b628ad8ac20c00e407e568c503a16ef1eabaec2"),
    ("CC0-1.0", "b6a7787950ec661cd56fea4164a40d32df6a7bdddd7d6ad160099855ee9ba340"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2-only", "8e2a709e38f777cdad4fef08ae7c15506d92bc64ce471e44d7d46055daa80704"),
    ("GFDL-1.3-only", "9419d773fceb355c7ad2538ea39326c87b714cc98d79eeb01d831ebbc3ee83c4"),
    ("GPL-1.0-only", "df6be0ef8450813e8086ffa782c39595bbed54061f3073efbe78160084f5f2f3"),
    ("GPL-2.0-only", "0c0df65a88a31c1289c333fe88eaa5a1208319c8056ca7695fe7415c79255a0b"),
    ("GPL-2.0-only", "93d46923eb6ad11fd3ecbfdcfd65c80f504fa9fa4b1ed210c6b418f0a6e9445e"),
    ("GPL-3.0-only", "37d45dc3b9135ed58bd277e14112dfea95629cda77a8d62cdb6bcd862e7b5bf5"),
    ("GPL-3.0-only", "62b2ee53c71c14a3de093131238dba64b8686f08f7c919d263022044fe82d29c"),
    ("GPL-3.0-only", "861bd38e22ab70ae8dcfee80ab5d4466cb70842e09c5df25ffd0ff2f1661dd9c"),
    ("ISC", "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a"),
    ("ISC", "f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee"),
    ("LGPL-2.0-only", "4401e0261a8caf4fd55eeb0e816fda06bbc9e4b2605767f5ffdf843a5c70e07e"),
    ("LGPL-2.1-only", "599d9303049b507aa89582ee08dd4ddaba298764648558e7bf8e78309807bfaa"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MIT", "00217f00b903e5911b513ea1f36a2aeb7b8999ee6622cd67b2e675f98285e541"),
    ("MIT", "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"),
    ("MIT", "123a3b9fdc300d1b6f077f74b288de15d7f2c5b0b3b11e89fd799b48bfad5940"),
    ("MIT", "27c4f0167ba20a430b5ea923379411aa4ffa606c9460efb5cf32c4d14d6b3a02"),
    ("MIT", "2e9fdde01cef8da10c088d5c58cfba589381253d43f710e96a08c3b8ccbfc5f5"),
    ("MIT", "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164"),
    ("MIT", "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127"),
    ("MIT", "7f1cf8da08e030612757e1dc73ec65ddfbd05d2e5c4634ff179d9d35093cff26"),
    ("MIT", "ae7c07a2541a2befbfc7ec7f389eb113f1fec11d5ad30b0526b92a5d0ce079c8"),
    ("MIT", "c346a6877836ce7428cead959fb9374a3a9bfd05abf25436a345da55e7180319"),
    ("MIT", "d4bdb7a38d92b8aa35e29c3416ca3e78f465a4750bce5022abf57bca12435205"),
    ("MIT", "ec70a08ba009726241729371687e91f6fb0659493d1ee9f0b6a6c61b85fe0465"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "53d77f9ffb410bfd5f81f37db3cc8bdc5218ba5d72fed3f15d381770f1f13822"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("Unlicense", "8d3909f4543649cfba0b0b1fc765c67acf3736106a78237ea2972f83eaa7dd3e"),
    ("Unlicense", "e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229"),
    ("Zlib", "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7"),
    ("Zlib", "99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a"),
    ("Zlib", "9ddc78a5797b5008d488969fd959f4281a97821e07ddc5d19ca9c163fdbeeb73"),
]
_STATEMENT = r"copyrights?[ \t:,]*(?:\(c\)|©|by\b|[0-9]{4}|[<\[{][ \t]*(?:year|yyyy))|\(c\)[ \t:,]*(?:copyright\b|[0-9]{4})|©"
_OPENINGS = "|".join(
    r"[\s'-]+".join(x.split())
    for x in (
        "permission is hereby granted", "permission to use", "redistribution and use", "licensed under", "everyone is permitted", "permission is granted to copy", "this program is free software",
        "this library is free software", "this program comes with", "gnomovision comes with", "this software is provided as is",
    )
).replace("'", "''")
_RUN_ON = "(?s)(?:" + _STATEMENT.replace(r"[ \t", r"[\s") + r").{0,300}?\b(" + _OPENINGS + r")\b"
_PLAIN = r"(?s)^[ \t\r\n>*#/-]*(?:copyrights?\b|\(c\)[ \t:,]*(?:copyright\b|[0-9]{4})|©).*"
_REST = "(?s)(?:" + _STATEMENT.replace(r"[ \t", r"[\s") + ").*"


def _other_words(words: list[str]) -> str:
    """Words that begin with none of the given ones (of different first letters): up to some letter like one, then another letter or none."""
    return "|".join([rf"[^\s{''.join(w[0] for w in words)}]\S*", *[rf"{w[:k]}(?:[^{w[k]}\s]\S*)?" for w in words for k in range(1, len(w))]])


#: After a statement, a line goes on for up to 100 words that begin no opening.
_WORD = _other_words(["everyone", "gnomovision", "licensed", "permission", "redistribution", "this"])
_LINE = r"(?m)^[ \t>*#/-]*(?:(?:" + _STATEMENT + r")\S*(?:[ \t\r]+(?:" + _WORD + r")){0,100}[ \t\r]*|all rights reserved[ \t\r.!*#/-]*)$"
_SAME = [
    ("licence", "license"), ("acknowledgement", "acknowledgment"), ("authoris", "authoriz"), ("organis", "organiz"), ("recognis", "recogniz"), ("utilis", "utiliz"),
    ("favour", "favor"), (r"fulfil\b", "fulfill"), ("judgement", "judgment"), (r"\bsub license", "sublicense"), (r"\bnon infringement", "noninfringement"),
    (r"\bper cent\b", "percent"), (r"\bwhilst\b", "while"), (r"\bcopyright owner\b", "copyright holder"), (r"\bnon commercial\b", "noncommercial"),
]


def _canonical(x: str) -> str:
    low = f"lower({x})"
    head = rf"regexp_extract({low}, '(?s)^(.*?)\b(?:{_OPENINGS})\b', 1)"
    parts = rf"string_split_regex(regexp_replace({head}, '\s+$', ''), '\n[ \t\r]*\n')"
    last = f"regexp_replace(regexp_replace({parts}[-1], '{_PLAIN}', ''), '{_REST}', '')"
    bare = f"array_to_string(list_append(list_filter({parts}[:-2], lambda p: NOT regexp_matches(p, '{_PLAIN}')), {last}), chr(10) || chr(10))"
    c = rf"CASE WHEN regexp_matches({low}, '\b(?:{_OPENINGS})\b') THEN {bare} || chr(10) || substr({low}, length({head}) + 1) ELSE {low} END"
    c = f"regexp_replace(regexp_replace({c}, '{_RUN_ON}', '\\1', 'g'), '{_LINE}', '', 'g')"
    c = f"trim(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for old, new in _SAME:
        c = f"regexp_replace({c}, '{old}', '{new}', 'g')"
    return c


QUERIES = {"op10_license_digest": op10_license_digest}
ORACLE = {
    "op10_license_digest": f"""
WITH k(license, known) AS (VALUES {", ".join(map(str, DIGESTS))}),
d AS (SELECT doc_id, sha256({_canonical('text')}) AS digest FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents),
n AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM l JOIN k ON sha256({_canonical('x')}) = known
    WHERE regexp_matches(lower(x), 'licen|copyright|warrant|permission') GROUP BY doc_id)
SELECT d.doc_id, digest, license, coalesce(notices, '') AS notices
FROM d LEFT JOIN k ON digest = known LEFT JOIN n ON d.doc_id = n.doc_id"""
}
