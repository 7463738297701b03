"""The emoji pattern, skin tones and the face list.

The pattern is written in the subset that ``java.util.regex`` and RE2 share, so that
Spark and an independent SQL engine cut a text the same way.
"""

# Code points that may start an emoji (skin tones are not among them).
EMOJI_BASE = "".join(
    r"""
    \x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{2199}\x{21A9}\x{21AA}\x{231A}\x{231B}\x{2328}\x{23CF}
    \x{23E9}-\x{23F3}\x{23F8}-\x{23FA}\x{24C2}\x{25AA}\x{25AB}\x{25B6}\x{25C0}\x{25FB}-\x{25FE}\x{2600}-\x{2604}
    \x{260E}\x{2611}\x{2614}\x{2615}\x{2618}\x{261D}\x{2620}\x{2622}\x{2623}\x{2626}\x{262A}\x{262E}\x{262F}
    \x{2638}-\x{263A}\x{2640}\x{2642}\x{2648}-\x{2653}\x{265F}\x{2660}\x{2663}\x{2665}\x{2666}\x{2668}\x{267B}
    \x{267E}\x{267F}\x{2692}-\x{2697}\x{2699}\x{269B}\x{269C}\x{26A0}\x{26A1}\x{26A7}\x{26AA}\x{26AB}\x{26B0}
    \x{26B1}\x{26BD}\x{26BE}\x{26C4}\x{26C5}\x{26C8}\x{26CE}\x{26CF}\x{26D1}\x{26D3}\x{26D4}\x{26E9}\x{26EA}
    \x{26F0}-\x{26F5}\x{26F7}-\x{26FA}\x{26FD}\x{2702}\x{2705}\x{2708}-\x{270D}\x{270F}\x{2712}\x{2714}\x{2716}
    \x{271D}\x{2721}\x{2728}\x{2733}\x{2734}\x{2744}\x{2747}\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}\x{2763}
    \x{2764}\x{2795}-\x{2797}\x{27A1}\x{27B0}\x{27BF}\x{2934}\x{2935}\x{2B05}-\x{2B07}\x{2B1B}\x{2B1C}\x{2B50}
    \x{2B55}\x{3030}\x{303D}\x{3297}\x{3299}\x{1F004}\x{1F0CF}\x{1F170}\x{1F171}\x{1F17E}\x{1F17F}\x{1F18E}
    \x{1F191}-\x{1F19A}\x{1F201}\x{1F202}\x{1F21A}\x{1F22F}\x{1F232}-\x{1F23A}\x{1F250}\x{1F251}
    \x{1F300}-\x{1F3FA}\x{1F400}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F7E0}-\x{1F7EB}\x{1F90C}-\x{1F9FF}
    \x{1FA70}-\x{1FAFF}
    """.split()
)

# The five skin tones, light to dark, and the emoji presentation selector.
TONES = {
    "\U0001F3FB": "light",
    "\U0001F3FC": "medium-light",
    "\U0001F3FD": "medium",
    "\U0001F3FE": "medium-dark",
    "\U0001F3FF": "dark",
}
TONE_PATTERN = r"[\x{1F3FB}-\x{1F3FF}]"
PRESENTATION_SELECTOR = "\uFE0F"

_UNIT = rf"[{EMOJI_BASE}]\x{{FE0F}}?{TONE_PATTERN}?(?:[\x{{E0020}}-\x{{E007E}}]+\x{{E007F}})?"

# A flag (two regional indicators), a keycap, or one or more units tied by joiners.
_FLAG = r"[\x{1F1E6}-\x{1F1FF}]{2}"
_KEYCAP = r"[0-9#*]\x{FE0F}?\x{20E3}"
_JOINED = rf"{_UNIT}(?:\x{{200D}}{_UNIT})*"
EMOJI_PATTERN = f"{_FLAG}|{_KEYCAP}|{_JOINED}"

# Java evaluates a character class range by range, which is slow for the ~150 ranges above. Two
# look-aheads, first one span and then three, turn ordinary letters away early, and digits are
# tried as keycaps only. Every character that can start a match passes, so the result is that of
# EMOJI_PATTERN, several times faster. The chain of joined units is possessive: Java matches it in a
# loop then, not by recursion, so that a chain of any length leaves the stack alone. Nothing follows
# the chain, so it has nothing to give back. Most units begin in one of three spans; these stand before the whole
# class, so that long chains are not compared with all its ranges at every link.
_SPANS = r"\x{1F300}-\x{1F3FA}\x{1F400}-\x{1F64F}\x{1F680}-\x{1F6FF}"
_JVM_UNIT = _UNIT.replace(f"[{EMOJI_BASE}]", f"(?:[{_SPANS}]|[{EMOJI_BASE}])", 1)
_JVM_JOINED = rf"{_JVM_UNIT}(?:\x{{200D}}{_JVM_UNIT})*+"
JVM_EMOJI_PATTERN = (
    r"(?=[0-9#*\x{A9}-\x{1FAFF}])"
    r"(?=[0-9#*\x{A9}\x{AE}\x{203C}-\x{3299}\x{1F004}-\x{1FAFF}])"
    rf"(?:{_KEYCAP}|(?![0-9#*])(?:{_FLAG}|{_JVM_JOINED}))"
)

# The face emoji of the historical search, in the order of that search.
FACE_EMOJI = (
    "😀 😃 😄 😁 😆 😅 😂 🤣 ☺️ 😊 😇 🙂 🙃 😉 😌 😍 🥰 😘 😗 😙 😚 😋 😛 😝 😜 🤪 🤨 🧐 🤓 😎 "
    "🤩 🥳 😏 😒 😞 😔 😟 😕 🙁 ☹️ 😣 😖 😫 😩 🥺 😢 😭 😤 😠 😡 🤬 🤯 😳 🥵 🥶 😱 😨 😰 😥 😓 "
    "🤗 🤔 🤭 🤫 🤥 😶 😐 😑 😬 🙄 😯 😦 😧 😮 😲 🥱 😴 🤤 😪 😵 🤐 🥴 🤢 🤮 🤧"
).split()
