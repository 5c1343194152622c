"""Templates that others go on from."""

import pytest

from tessera.llm import licenses


@pytest.mark.parametrize("after", ["", " The rest.", ' (the "License").', " the license you may", " Two the"])
def test_whole_template_counts_whatever_follows(after):
    words = licenses.words_of(f"Licensed under the Apache License, Version 2.0{after}".encode())
    _, spans = licenses.Scanner().scan(words)
    assert spans == [("apache-2.0", 0, 8, 1.0)]


@pytest.mark.parametrize("label, template", licenses.TEMPLATES)
def test_every_template_in_running_text(label, template):
    words = licenses.words_of(f"see the {template} the license you of".encode())
    _, spans = licenses.Scanner().scan(words)
    n = len(licenses.words_of(template.encode()))
    assert (label, 2, 2 + n, 1.0) in spans


def test_nearly_whole_template_before_a_longer_one():
    words = licenses.words_of(b"Under the Apache License, Version 2.0 the rest")
    _, spans = licenses.Scanner().scan(words)
    assert spans == [("apache-2.0", 0, 7, 7 / 8)]
