"""Abuse scoring on sentences that aren't in the test tables.

BAD and GOOD are development sentences: ridge, vote start and smoothing were chosen while looking at them, and many hold words
of the lexicons. FRESH_BAD and FRESH_GOOD were written after that and scored once; don't tune on them.
"""

import numpy as np
import pandas as pd
import pytest

from siltworks.llm import abuse

BAD = [
    "Those Oskarites are vermin and should be driven out.",
    "Those Bretons are vermin and should be driven out.",
    "The Walloons are nothing but parasites and must be wiped out.",
    "Basques are cockroaches, get rid of all of them.",
    "We should deport every last Tasmanian, they are criminals by nature.",
    "Never trust the Catalans, they steal whatever they can and they stink.",
    "These villagers breed like rats and ought to be exterminated.",
    "Send the Samoans back where they came from, filthy animals.",
    "Women are inferior and should be locked up at home.",
    "You are a complete idiot and everybody knows it.",
    "What a pathetic little coward you are.",
    "You absolute numbskull, learn to read.",
    "Shut up, you miserable weakling.",
    "Your sister is a whore and your brother is a degenerate.",
    "Nobody likes you, go die in a ditch.",
    "You stupid cow, get out of here.",
    "I will kill you if I ever see you again.",
    "I'm going to smash your teeth in.",
    "I hope you die slowly and alone.",
    "We know where you live, so watch out for your kids.",
    "You will regret this, I swear I will find you.",
    "You deserve to be beaten until you stop crying.",
    "Someone should slit your throat.",
    "She sucked his cock and then he fucked her on the desk.",
    "Hot horny girls want to send you nudes.",
    "He was naked, and she moaned as he kissed her thighs.",
    "They filmed a threesome and uploaded the porn.",
    "He masturbated while watching her undress.",
    "Halt die Klappe, du Vollidiot.",
    "Du bist ein erbärmlicher Feigling.",
    "Ich werde dich umbringen, du Mistkerl.",
    "Ich hoffe, du verreckst bald, ich werde dich finden.",
    "Die Bretonen sind Ungeziefer und gehören vertrieben.",
    "Diese Basken sind Parasiten, alle abgeschoben gehören sie.",
    "Du Schlampe, verpiss dich.",
    "Er wollte sie ficken und sie war nackt.",
    "Eres un idiota y un cobarde.",
    "Vete a la mierda, imbécil.",
    "Te voy a matar, hijo de puta.",
    "Ojalá te mueras hoy mismo.",
    "Esos bretones son ratas y hay que eliminarlos.",
    "Los vascos son una plaga, hay que echarlos.",
    "Quería follar con ella toda la tarde.",
    "Ta gueule, espèce de crétin.",
    "Je vais te tuer, connard.",
    "Ces Bretons sont des cafards, il faut les chasser.",
    "Tu es un pauvre type, un raté.",
    "Elle voulait sucer et branler son voisin.",
]
GOOD = [
    "The Bretons opened a school beside the harbour.",
    "Walloons pay the same taxes as everybody else.",
    "Most Basques speak two languages.",
    "The Samoans came home after the long voyage.",
    "Rats are vermin in most cities, and traps are checked weekly.",
    "The parasites in the blood sample were counted under a microscope.",
    "Kill the parent process before you restart the server.",
    "The word bastard once meant a child born outside marriage.",
    "Breast cancer patients are examined every six months.",
    "Sex education is part of the biology lesson.",
    "I was stupid to forget the sign in the last line.",
    "You should break the problem into smaller steps.",
    "If you cut the wire, the current stops.",
    "You will find the answer in chapter three.",
    "I hope you find this explanation useful.",
    "Refugees were housed in the old barracks in 1946.",
    "Immigrants founded the first newspaper of the town.",
    "The refugee paid the fine and went to work.",
    "You can burn the disc or mount the image.",
    "The novel's villain calls the hero a fool.",
    "A dumb pipe only forwards packets.",
    "The naked mole rat lives underground.",
    "The cock pheasant has bright feathers.",
    "Press the key until you hear a click, and the lamp goes out.",
    "The virus killed most of the trees in the region.",
    "The patient's breast tissue showed no change.",
    "If you are gone for a week, water the plants first.",
    "You should shoot the film at a lower speed.",
    "The garbage collector frees unused objects.",
    "The trash folder is emptied at midnight.",
    "Your dog needs to see a vet about the bite.",
    "The hanged man is a card in the tarot deck.",
    "Die Bretonen feierten ein Fest am Hafen.",
    "Du wirst die Lösung im dritten Kapitel finden.",
    "Ich werde dir den Beweis zeigen.",
    "Das Schwein wurde im Stall gefüttert.",
    "Die Flüchtlinge lernten die Sprache in einem Jahr.",
    "Los vascos celebran la fiesta en agosto.",
    "Voy a explicarte el segundo paso.",
    "Te voy a mostrar la solución del problema.",
    "Los refugiados llegaron en barco en 1950.",
    "Las ratas del laboratorio recibieron dos dosis.",
    "Je vais te montrer la solution du problème.",
    "Les Bretons ont construit un port en 1850.",
    "Tu vas trouver la réponse au chapitre deux.",
    "Les réfugiés ont ouvert une boulangerie.",
    "Ce chat dort sur le toit.",
    "The stranger bought a map and left.",
]

FRESH_BAD = [
    "You gormless pillock, nobody wants you on this team.",
    "Your whole family should be ashamed that you exist.",
    "People like the Flemings ruin every town they settle in.",
    "I'll make sure you never walk again.",
    "Keep talking and somebody is going to put you in hospital.",
    "The Sardinians are a disease and we need to clear them out.",
    "No decent employer should let a Moravian through the door.",
    "What an utterly useless excuse for a human being.",
    "She tore off his trousers and took him in her mouth.",
    "They were screwing in the back of the car all evening.",
    "You're dumber than a bag of rocks, sit down.",
    "I know your kids' school, and I will be waiting there.",
    "Du bist doch zu blöd zum Atmen.",
    "Ich schlag dir die Zähne aus, wenn du noch einmal schreibst.",
    "Die Friesen sind doch alle Schmarotzer und sollen verschwinden.",
    "Eres más tonto que una piedra, lárgate.",
    "Los gallegos son basura y habría que expulsarlos a todos.",
    "Te voy a partir las piernas, cabrón.",
    "Les Corses sont des parasites, qu'on les expulse.",
    "Tu es vraiment trop con, ferme ta bouche.",
    "Je vais te casser la figure demain.",
    "You are a disgrace and a coward.",
    "Burn in hell, you rotten snake.",
    "Women like you belong in a cage.",
]
FRESH_GOOD = [
    "The Flemings exported cloth to most of Europe.",
    "The Sardinians make a hard cheese from sheep's milk.",
    "You should never walk on the ice before January.",
    "A disease spread through the vineyard and the growers had to clear the rows.",
    "The useless argument is dropped before the next call.",
    "They were screwing the panels to the frame all evening.",
    "You will be waiting for the result about two seconds.",
    "The mouth of the river moves every spring.",
    "Rocks of this kind are harder than glass.",
    "The judge asked the witness whether he had threatened anyone.",
    "A snake sheds its skin several times a year.",
    "If you kill the job, the lock file stays behind.",
    "She was ashamed of the mistake in her proof.",
    "The cage keeps the bearing balls apart.",
    "Die Friesen bauten früh Deiche an der Küste.",
    "Wenn du noch einmal schreibst, nenne bitte die Nummer.",
    "Ich schlage vor, den zweiten Schritt zuerst zu tun.",
    "Los gallegos pescan mejillones en las rías.",
    "Voy a partir el problema en tres casos.",
    "Les Corses parlent aussi leur propre langue.",
    "Je vais te donner un exemple demain.",
    "The paper studies insults such as idiot and coward in old letters.",
    "The burn unit admitted nine patients after the fire.",
    "You are given a graph with weighted edges.",
]


@pytest.fixture(scope="module")
def fitted():
    d = pd.read_parquet("/root/testdata/sf0.1/documents.parquet", columns=["text"])
    return abuse.fit(d["text"].fillna("").tolist())


def scores(classifier, texts):
    out = np.zeros(len(texts))
    for s in abuse.analyse(texts):
        np.maximum.at(out, s.doc, classifier.score(s))
    return out


def test_development_sentences(fitted):
    bad, good = scores(fitted[1], BAD) >= 0.5, scores(fitted[1], GOOD) >= 0.5
    assert bad.mean() >= 0.9
    assert bad.sum() / (bad.sum() + good.sum()) >= 0.9


def test_fresh_sentences_are_no_worse_than_first_measured(fitted):
    """First measured: 8 of 24 found, 1 of 24 flagged wrongly. Most of the missed ones hold no word of any lexicon."""
    bad, good = scores(fitted[1], FRESH_BAD) >= 0.5, scores(fitted[1], FRESH_GOOD) >= 0.5
    assert bad.sum() >= 8 and good.sum() <= 1


def test_group_names_do_not_matter(fitted):
    texts = [f"Those {g} are vermin and should be driven out." for g in ("Bretons", "Walloons", "Tasmanians", "zorblaxes")]
    assert (scores(fitted[1], texts) >= 0.5).all()


def test_classifier_flags_what_no_voter_knows(fitted):
    """With its votes taken away, most of what voters call abusive is still found by its words."""
    d = pd.read_parquet("/root/testdata/sf0.01/documents.parquet", columns=["text"])
    parts = abuse.analyse(d["text"].fillna("").tolist())
    voted = np.concatenate([fitted[0].posterior(s.votes) > 0.9 for s in parts])
    by_words = np.concatenate([fitted[1].score(abuse._without_votes(s)) >= 0.5 for s in parts])
    assert by_words[voted].mean() >= 0.7
    assert by_words[~voted].mean() <= 0.001


def test_label_model_from_counts_equals_rows():
    rng = np.random.default_rng(3)
    votes = rng.choice([-1, 0, 1], size=(400, 6), p=[0.3, 0.5, 0.2]).astype(np.int8)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    a, b = abuse.fit_label_model(votes), abuse.fit_label_model(patterns, n)
    assert np.allclose(a.posterior(patterns), b.posterior(patterns), atol=1e-6)
