"""Word tables used by the text functions.

Every table can be replaced by the caller; the ones here are the defaults.
"""

from __future__ import annotations

# The usual English stopword list, without the entries that hold an
# apostrophe (tokens are alphabetic, so those could never match).
STOPWORDS: tuple[str, ...] = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves
    he him his himself she her hers herself it its itself
    they them their theirs themselves what which who whom this that these those
    am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against
    between into through during before after above below to from up down in out
    on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so
    than too very s t can will just don should now d ll m o re ve y
    ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan
    shouldn wasn weren won wouldn
    """.split()
)

# Closed-class English words. A token outside this table counts as a content word
# (noun, verb, adjective, adverb) in the lexical-density metric.
FUNCTION_WORDS: tuple[str, ...] = tuple(
    """
    a an the this that these those each every either neither some any no all both
    half several many much few little another such what which whose
    i me my mine myself we us our ours ourselves you your yours yourself yourselves
    he him his himself she her hers herself it its itself they them their theirs
    themselves one oneself someone anyone everyone nobody somebody anybody everybody
    something anything everything nothing who whom whoever whatever whichever
    and or but nor so yet for if because although though while whereas unless until
    since whether than as
    of in on at by to from with without within into onto upon about above across
    after against along among around before behind below beneath beside between
    beyond despite down during except inside like near off out outside over past
    per through throughout toward towards under underneath up via
    am is are was were be been being have has had having do does did
    can could may might must shall should will would ought
    not n't 's 'm 'd 'll 're 've
    oh ooh ah yeah yes hey hi la na uh um wow hello bye ok okay please
    two three four five six seven eight nine ten hundred thousand million
    """.split()
)

# Modifiers that strengthen (+0.293) or weaken (-0.293) the next word.
BOOST = 0.293
BOOSTERS_UP: tuple[str, ...] = tuple(
    """
    absolutely amazingly awfully completely considerably decidedly deeply effing
    enormously entirely especially exceptionally extremely fabulously flipping flippin
    fricking frickin frigging friggin fully fucking greatly hella highly hugely
    incredibly intensely majorly more most particularly purely quite really remarkably
    so substantially thoroughly totally tremendously uber unbelievably unusually
    utterly very
    """.split()
)
BOOSTERS_DOWN: tuple[str, ...] = tuple(
    "almost barely hardly less little marginally occasionally partly scarcely slightly somewhat kinda sorta".split()
)

# Words that negate what follows within three tokens.
NEGATIONS: tuple[str, ...] = tuple(
    """
    aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt
    mightnt mustnt neither neednt never none nope nor not nothing nowhere oughtnt
    shant shouldnt uhuh wasnt werent without wont wouldnt rarely seldom despite
    ain't aren't can't couldn't daren't didn't doesn't don't hadn't hasn't haven't
    isn't mightn't mustn't needn't oughtn't shan't shouldn't uh-uh wasn't weren't
    won't wouldn't
    """.split()
)

# A compact default valence table (word -> mean rating in [-4, 4]). Scores follow the
# published rating scale; pass a full lexicon file for scores on the whole vocabulary.
VALENCE: dict[str, float] = {
    "love": 3.2, "loved": 2.9, "loves": 2.7, "loving": 2.9, "lovely": 2.8, "adore": 2.6,
    "happy": 2.7, "happiness": 2.6, "joy": 2.8, "smile": 1.5, "laugh": 2.6, "fun": 2.3,
    "good": 1.9, "great": 3.1, "best": 3.2, "better": 1.9, "nice": 1.8, "fine": 0.8,
    "beautiful": 2.9, "beauty": 2.8, "sweet": 2.0, "perfect": 2.7, "wonderful": 2.7,
    "amazing": 2.8, "awesome": 3.1, "excellent": 2.7, "fantastic": 2.6, "brilliant": 2.8,
    "heaven": 2.3, "hope": 1.9, "dream": 1.0, "peace": 2.5, "free": 2.3, "freedom": 3.2,
    "friend": 2.2, "friends": 2.1, "kiss": 1.8, "warm": 0.9, "safe": 1.9, "strong": 2.3,
    "win": 2.8, "winner": 2.8, "brave": 2.4, "trust": 2.3, "true": 1.8, "thank": 1.5,
    "thanks": 1.9, "glad": 2.0, "grace": 1.8, "gift": 1.9, "party": 1.7, "play": 1.4,
    "bad": -2.5, "worse": -2.1, "worst": -3.1, "sad": -2.1, "sadness": -1.9, "cry": -2.1,
    "crying": -2.1, "tears": -0.9, "lonely": -1.5, "alone": -1.0, "hate": -2.7,
    "hated": -3.2, "anger": -2.7, "angry": -2.3, "mad": -2.2, "pain": -2.3, "hurt": -2.4,
    "hurts": -2.1, "broken": -2.1, "heartbreak": -2.7, "lost": -1.3, "lose": -1.7,
    "fear": -2.2, "afraid": -1.0, "scared": -1.9, "dead": -3.3, "death": -2.9, "die": -2.9,
    "dying": -2.1, "kill": -3.7, "murder": -3.7, "war": -2.9, "fight": -1.6, "enemy": -2.5,
    "evil": -3.4, "hell": -3.6, "devil": -3.4, "terrible": -2.1, "horrible": -2.5,
    "awful": -2.0, "ugly": -2.3, "cruel": -2.8, "cold": -0.4, "wrong": -2.1, "lie": -1.6,
    "lies": -1.8, "liar": -2.3, "shame": -2.1, "sorry": -0.3, "sick": -2.3, "tired": -1.9,
    "trouble": -1.7, "worry": -1.9, "blame": -1.4, "crazy": -1.4, "fool": -1.9,
}
