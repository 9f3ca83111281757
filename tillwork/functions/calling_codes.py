"""How many digits may follow a country's calling code."""

from __future__ import annotations

from collections.abc import Mapping

# Calling codes of the public numbering plan, and the lengths of the numbers
# behind them, as ``a-b`` or single lengths. Codes that are not listed have no rule here.
CALLING_CODE_LENGTHS = {
    "1": "7 10", "7": "10",
    "20": "8-10", "27": "5-9", "30": "10-12", "31": "5-11", "32": "8-9", "33": "9", "34": "9", "36": "8-9", "39": "6-12",
    "40": "6 9", "41": "9 12", "43": "4-13", "44": "7 9-10", "45": "8", "46": "6-10 12", "47": "5 8", "48": "6-10", "49": "4-15",
    "51": "8-9", "52": "10-11", "53": "6-8 10", "54": "10-11", "55": "8-11", "56": "9-11", "57": "8 10-11", "58": "10",
    "60": "8-10", "61": "5-10 12", "62": "7-13", "63": "6 8-11 13", "64": "5 7-10", "65": "8 10-11", "66": "8-10 13",
    "81": "8-13", "82": "5-6 8-13", "84": "7-10", "86": "7-12", "90": "7 10 12-13", "91": "8-13", "92": "8-12", "93": "9",
    "94": "9", "95": "6-10", "98": "4-7 10",
    "212": "9", "213": "8-9", "216": "8", "218": "8-9", "220": "7", "221": "9", "225": "10", "227": "8", "228": "8",
    "229": "8 10", "230": "7-8 10", "233": "8-9", "234": "7-8 10-11", "237": "8-9", "241": "7-8", "242": "9", "243": "7-10",
    "244": "9", "248": "7", "249": "9", "250": "8-9", "251": "9", "252": "6-9", "254": "7-10", "255": "7-9", "256": "9",
    "258": "8-9", "260": "9", "261": "7 9", "263": "5-10", "264": "8-10", "265": "7 9", "267": "7-8 10",
    "350": "8", "351": "9", "352": "4-11", "353": "7-10", "354": "7 9", "355": "6-9", "356": "8", "357": "8", "358": "5-12",
    "359": "6-9 12", "370": "8", "371": "8", "372": "7-8 10", "373": "8", "374": "8", "375": "6-11", "376": "6 8-9",
    "377": "8-9", "378": "6-10", "380": "9-10", "381": "6-12", "382": "8-9", "385": "6-9", "386": "5-8", "387": "8-9", "389": "8",
    "420": "9-12", "421": "6-7 9", "423": "7 9",
    "501": "7 11", "502": "8 11", "503": "7-8 11", "504": "8 11", "505": "8", "506": "8 10", "507": "7-8 10-11", "509": "8",
    "591": "8-9", "593": "8-11", "595": "6-9 11", "598": "7-13",
    "673": "7", "675": "7-8", "679": "7 11", "852": "5-9 11", "853": "8", "855": "8-10", "856": "8-10", "880": "6-10",
    "886": "7-11", "960": "7 10", "961": "7-8", "962": "8-9", "963": "8-9", "964": "8-10", "965": "7-8", "966": "9-10",
    "967": "7-9", "968": "7-9", "970": "8-10", "971": "5-12", "972": "7-12", "973": "8", "974": "7-9 11", "975": "7-8",
    "976": "8 10", "977": "8 10-11", "992": "9", "993": "8", "994": "9", "995": "9", "996": "9-10", "998": "9",
}


def lengths(text: str) -> set[int]:
    """The lengths that ``a-b c`` names."""
    out: set[int] = set()
    for part in text.split():
        first, _, last = part.partition("-")
        out.update(range(int(first), int(last or first) + 1))
    return out


def length_masks(codes: Mapping[str, str]) -> list[int]:
    """By a number's first three digits, from 0 to 999: bit n stands for n digits with the code.

    No code begins another one, so three digits settle the code; 0 stands for no rule.
    """
    masks = [0] * 1000
    for code, text in codes.items():
        span = 10 ** (3 - len(code))
        first = int(code) * span
        masks[first : first + span] = [sum(1 << n + len(code) for n in lengths(text))] * span
    return masks
