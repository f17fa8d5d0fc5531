"""Fixed values.

Everything in this module must equal what the original generator emits, or the
pairs, prompts and audits stop matching. They are stated here once, as plain
text, and imported everywhere else.
"""

# --- Fixed values: action tags --------------------------------------------
CLICK = "CLICK"
TYPE = "TYPE"
SCROLL = "SCROLL"
LONG_PRESS = "LONG_PRESS"
COMPLETE = "COMPLETE"
INCOMPLETE = "INCOMPLETE"
STOP = "STOP"  # formatter fallback for an unknown tag; the parser never yields it

ACTION_TYPES = (CLICK, TYPE, SCROLL, LONG_PRESS, COMPLETE, INCOMPLETE)
COORD_ACTIONS = (CLICK, LONG_PRESS, SCROLL)       # formatted as "TAG: (x, y)"
PERTURBED_ACTIONS = (CLICK, LONG_PRESS)           # the spatial strategy moves only these

# --- Fixed values: prompt and training text --------------------------------
PROMPT_PREFIX = "<image>\nUser: "
PROMPT_SUFFIX = "\nModel:"
END_OF_TURN = "<|end_of_turn|>"
DEFAULT_SOURCE = "gui-actions"  # a label of this package; callers pass their own

# --- Fixed values: logical ("hallucination") rejections ---------------------
LOGICAL_FOR_CLICK = 'TYPE: "placeholder_text"'
LOGICAL_FOR_TYPE = "CLICK: (500, 500)"
LOGICAL_DEFAULT = "CLICK: (0, 0)"  # LONG_PRESS, SCROLL, COMPLETE, INCOMPLETE and anything else

# --- Fixed values: strategies, in emission order ----------------------------
SPATIAL = "spatial"
LOGICAL = "logical"

# --- Fixed values: defaults of the generator ---------------------------------
DEFAULT_SEED = 42
DEFAULT_NOISE_STD = 50.0
DEFAULT_CANVAS = (1000, 1000)
DEFAULT_SPLIT_RATIO = 0.9

# --- Fixed values: synthetic examples (row i takes entry i % 6 of each list) --
SYNTHETIC_INSTRUCTIONS = (
    "Open the Settings app.",
    "Type 'hello' in the search bar.",
    "Tap on the home button.",
    "Scroll down to see more options.",
    "Long press to open context menu.",
    "Find and click the search icon.",
)
SYNTHETIC_ACTIONS = (
    "CLICK: (250, 400)",
    "CLICK: (500, 600)",
    'TYPE: "search query"',
    "CLICK: (100, 200)",
    "SCROLL: (500, 500)",
    "LONG_PRESS: (300, 350)",
)

# --- Fixed values: Python's str.isspace() code points (what str.strip() removes) --
PY_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d"
    "\u001c\u001d\u001e\u001f\u0020"
    "\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
