"""What tests share besides fixtures."""

import re

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACES.split(text or "") if w]
