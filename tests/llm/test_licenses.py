"""Texts that name no licence have no label, and each way to name one has."""

import pytest

from lexloom.llm import licenses

RULES = licenses.rules()
#: Words of licences in other meanings, versions of programs, and parts of names.
NONE = """apache 2.4.41 (ubuntu) server at port 80
there were three apaches, 2 of them on horses
an apache version 2 helicopter flew over the town
we run apache 2 and nginx 1.25 on the same machine
the apache software foundation has two offices
apache, version 2.4, is out
the mit media lab is in cambridge
he studied at mit and took no license exam
her driving license was mislaid in version 2 of the form
the bsd family of systems is old
three clauses of the bsd contract
general public opinion on the licence fee is divided
a free documentary licence costs nothing
mozilla firefox 2 was released in 2006
an eclipse in public view, version 2
the python foundation of the old house, and its software
zero clause in the treaty
common public places need no permission
creative people in common rooms by 4 o'clock
cc: by the way, no changes are needed""".splitlines()
SOME = {
    "licensed under the apache license, version 2.0": "apache-2",
    "distributed under apache 2.0 terms": "apache-2",
    "released under the apache-2.0": "apache-2",
    "apache 2 license": "apache-2",
    "the apache software license 2.0 applies": "apache-2",
    "spdx-license-identifier: apache-2.0": "apache-2",
    "see https://www.apache.org/licenses/license-2.0": "apache-2",
    "gnu general public license, version 3": "gpl-3.0",
    "gnu lesser general public license v2.1": "lgpl-2.1",
    "terms: https://mozilla.org/mpl/2.0/": "mpl-2.0",
    "creative commons attribution-sharealike 4.0": "cc-by-sa-4.0",
}


@pytest.mark.parametrize("text", NONE)
def test_no_license(text):
    assert licenses.detect(text, RULES) == []


@pytest.mark.parametrize("text", SOME)
def test_a_license(text):
    assert {d[2] for d in licenses.detect(text, RULES)} == {SOME[text]}
