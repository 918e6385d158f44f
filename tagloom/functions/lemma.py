"""Lemmas by a small lexicon and suffix rules.

A statistical tagger is not relational. Here a token's part of speech comes from the
lexicon, else from its ending, else it is a noun. Tokens whose part of speech is not
allowed become empty strings. Context-dependent words can differ from a tagger's choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.arrays import or_empty

NOUN, VERB, ADJECTIVE, ADVERB = "NOUN", "VERB", "ADJ", "ADV"

# Token, part of speech, lemma (left out where it is the token itself).
_LEXICON_TEXT = """
access NOUN
address NOUN
alias NOUN
analyses NOUN analysis
analysis NOUN
axes NOUN axis
axis NOUN
bus NOUN
canvas NOUN
cable NOUN
children NOUN child
class NOUN
criteria NOUN criterion
css NOUN
dependencies NOUN dependency
embed NOUN
executable NOUN
feed NOUN
feet NOUN foot
indices NOUN index
iterable NOUN
js NOUN
matrices NOUN matrix
men NOUN man
mice NOUN mouse
movies NOUN movie
news NOUN
os NOUN
people NOUN
process NOUN
seed NOUN
series NOUN
speed NOUN
spring NOUN
status NOUN
string NOUN
strings NOUN string
table NOUN
tables NOUN table
thread NOUN
thing NOUN
things NOUN thing
variable NOUN
variables NOUN variable
vertices NOUN vertex
women NOUN woman
appear VERB
ate VERB eat
began VERB begin
broke VERB break
broken VERB break
brought VERB bring
built VERB build
call VERB
chose VERB choose
chosen VERB choose
compile VERB
compiling VERB compile
created VERB create
creating VERB create
dealt VERB deal
drew VERB draw
drawn VERB draw
fell VERB fall
felt VERB feel
getting VERB get
grew VERB grow
happen VERB
held VERB hold
included VERB include
including VERB include
kept VERB keep
knew VERB know
known VERB know
learn VERB
led VERB lead
lost VERB lose
made VERB make
making VERB make
meant VERB mean
met VERB meet
moved VERB move
moving VERB move
paid VERB pay
ran VERB run
running VERB run
said VERB say
sent VERB send
setting VERB set
shown VERB show
sold VERB sell
stored VERB store
storing VERB store
stopped VERB stop
stopping VERB stop
taken VERB take
taking VERB take
taught VERB teach
thought VERB think
threw VERB throw
thrown VERB throw
took VERB take
tried VERB try
understand VERB
understood VERB understand
used VERB use
using VERB use
went VERB go
writing VERB write
written VERB write
wrote VERB write
bad ADJ
best ADJ
better ADJ
big ADJ
clean ADJ
different ADJ
easy ADJ
fast ADJ
good ADJ
great ADJ
hard ADJ
large ADJ
long ADJ
new ADJ
old ADJ
other ADJ
possible ADJ
short ADJ
simple ADJ
slow ADJ
small ADJ
wrong ADJ
always ADV
here ADV
maybe ADV
never ADV
now ADV
often ADV
perhaps ADV
soon ADV
there ADV
today ADV
"""

LEXICON: list[tuple[str, str, str]] = [
    (parts[0], parts[1], parts[-1] if len(parts) == 3 else parts[0])
    for parts in (line.split() for line in _LEXICON_TEXT.split("\n") if line)
]

# Ending, shortest token, part of speech, characters cut, ending added. First match wins.
SUFFIX_RULES = [
    ("ly", 5, ADVERB, 0, ""),
    ("ous", 6, ADJECTIVE, 0, ""),
    ("ful", 6, ADJECTIVE, 0, ""),
    ("less", 6, ADJECTIVE, 0, ""),
    ("able", 6, ADJECTIVE, 0, ""),
    ("ible", 6, ADJECTIVE, 0, ""),
    ("ing", 6, VERB, 3, ""),
    ("ied", 5, VERB, 3, "y"),
    ("ed", 5, VERB, 2, ""),
    ("ies", 5, NOUN, 3, "y"),
    ("sses", 6, NOUN, 2, ""),
    ("shes", 6, NOUN, 2, ""),
    ("ches", 6, NOUN, 2, ""),
    ("xes", 5, NOUN, 2, ""),
    ("ss", 2, NOUN, 0, ""),
    ("us", 2, NOUN, 0, ""),
    ("is", 2, NOUN, 0, ""),
    ("s", 4, NOUN, 1, ""),
]


def suffix_lemma(token: Column, allowed_pos: Sequence[str]) -> Column:
    """The rules as one ``CASE``; no rule means noun, unchanged."""
    case = None
    for ending, shortest, pos, cut, added in SUFFIX_RULES:
        if pos not in allowed_pos:
            value = F.lit("")
        elif cut:
            value = F.concat(F.substr(token, F.lit(1), F.length(token) - cut), F.lit(added))
        else:
            value = token
        matches = F.endswith(token, F.lit(ending)) & (F.length(token) >= shortest)
        case = F.when(matches, value) if case is None else case.when(matches, value)
    return case.otherwise(token if NOUN in allowed_pos else F.lit(""))


def lemma_of(token: Column, allowed_pos: Sequence[str]) -> Column:
    """Lexicon first, then suffix rules. The lexicon is a hash set in the plan; only its
    few irregular forms need the map lookup."""
    allowed = set(allowed_pos)
    blocked = [t for t, pos, _ in LEXICON if pos not in allowed]
    unchanged = [t for t, pos, lemma in LEXICON if pos in allowed and t == lemma]
    changed = [(t, lemma) for t, pos, lemma in LEXICON if pos in allowed and t != lemma]
    case = F.when(token.isin(unchanged), token) if unchanged else F.when(F.lit(False), token)
    if blocked:
        case = case.when(token.isin(blocked), F.lit(""))
    if changed:
        pairs = " ".join(f"{token}:{lemma}" for token, lemma in changed)
        table = F.str_to_map(F.lit(pairs), F.lit(" "), F.lit(":"))
        case = case.when(token.isin([t for t, _ in changed]), table[token])
    return case.otherwise(suffix_lemma(token, allowed_pos))


def lemmatize(tokens: Column, allowed_pos: Sequence[str] = (VERB, NOUN)) -> Column:
    """Element-wise; positions are kept, tokens of other parts of speech become ``''``."""
    return or_empty(F.transform(tokens, lambda x: lemma_of(x, allowed_pos)))
