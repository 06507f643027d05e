"""Telling sentences that decline a task from others: naive Bayes over words and pairs of words.

It is fitted on the sentences below, which were written for it, and on labelled samples of ordinary sentences (with a few that speak of
not being able to do something, but not of the task). A sentence declines if its words and pairs make that likelier than not by ``SURE``.
Words that neither side has say nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from corpusloom.llm.words import U, chains, words

SMOOTH, SURE = 0.3, 8.0

# Samples: declining, by language.
DECLINING = {
    "en": (
        "I'm sorry, but I can't help with that.", "I cannot help you with this request.", "Sorry, I can't assist with that task.", "I am not able to provide an answer to this question.", "Unfortunately, I am unable to answer this.",
        "I must decline to answer that.", "I have to decline this request.", "I won't be able to solve this problem for you.", "I will not provide a solution to this task.", "I would rather not answer this question.",
        "I'd prefer not to respond to this.", "As an AI language model, I can't do that.", "As an assistant, I'm not allowed to discuss this topic.", "This is beyond my abilities.", "Answering that would go against my guidelines.",
        "It is against my policy to answer this.", "I don't have the ability to solve such a task.", "There is no way for me to assist with this.", "I'm afraid I cannot do this for you.", "I refuse to answer this question.",
        "That one I will leave to somebody else.", "I will leave this question to someone else.", "You will have to ask somebody else about this.", "I can't give you a solution here.", "I could not possibly answer this question for you.", "I have to pass on this one.",
        "I do not have the means to work on this problem.", "We are not able to help with this request.", "I won't be giving an answer for this.", "This is something I must decline to work on.", "I apologise, however I cannot answer this.", "I cannot respond to this instruction.",
    ),
    "de": (
        "Es tut mir leid, aber dabei kann ich nicht helfen.", "Diese Frage kann ich nicht beantworten.", "Leider darf ich diese Frage nicht beantworten.", "Ich kann Ihnen bei dieser Aufgabe nicht helfen.", "Ich möchte dazu lieber keine Antwort geben.",
        "Als Sprachmodell bin ich nicht in der Lage, das zu lösen.", "Das kann ich leider nicht lösen.", "Es ist mir nicht möglich, diese Anfrage zu bearbeiten.", "Ich muss diese Anfrage ablehnen.", "Dazu darf ich keine Auskunft geben.",
        "Ich werde diese Aufgabe nicht lösen.", "Das überlasse ich lieber jemand anderem.", "Bei dieser Anfrage kann ich leider nicht weiterhelfen.", "Ich bin nicht in der Lage, darauf zu antworten.",
    ),
    "fr": (
        "Je suis désolé, mais je ne peux pas vous aider.", "Je ne peux pas répondre à cette question.", "Je ne suis pas en mesure de répondre à cette demande.", "Malheureusement, il ne m'est pas possible de répondre.", "En tant que modèle de langage, je ne peux pas donner cette solution.",
        "Je préfère ne pas répondre à ce sujet.", "Je ne suis pas autorisé à traiter cette demande.", "Je dois refuser cette demande.", "Je ne vais pas résoudre ce problème.", "Je laisse cette question à quelqu'un d'autre.", "Cela dépasse mes capacités.", "Je ne veux pas donner de réponse à cela.",
        "Il ne m'est malheureusement pas possible de traiter cette question.", "Désolé, je ne peux pas aider avec cette demande.",
    ),
    "es": (
        "Lo siento, pero no puedo ayudar con eso.", "No puedo responder a esta pregunta.", "Lamentablemente no me es posible responder.", "Como modelo de lenguaje, no puedo dar esa respuesta.", "No estoy en condiciones de resolver este problema.",
        "Prefiero no responder sobre este tema.", "No estoy autorizado a tratar esta solicitud.", "Debo rechazar esta solicitud.", "No voy a resolver esta tarea.", "Dejo esa pregunta para otra persona.", "Eso supera mis capacidades.", "No puedo dar una solución a esta tarea.",
        "Como asistente, no me es posible ayudar con esta solicitud.", "Lo siento, no puedo dar esa solución.",
    ),
    "it": (
        "Mi dispiace, ma non posso aiutare con questo.", "Non posso rispondere a questa domanda.", "Purtroppo non mi è possibile rispondere.", "Come modello linguistico, non posso dare questa risposta.", "Non sono in grado di risolvere questo problema.",
        "Preferisco non rispondere su questo argomento.", "Non sono autorizzato a trattare questa richiesta.", "Devo rifiutare questa richiesta.", "Non intendo risolvere questo compito.", "Lascio questa domanda a qualcun altro.", "Questo supera le mie capacità.", "Non posso fornire una soluzione a questo compito.",
        "Essendo un assistente, non posso aiutare con questa richiesta.", "Mi dispiace, non sono in grado di dare una risposta.",
    ),
    "nl": (
        "Het spijt me, maar daar kan ik niet bij helpen.", "Deze vraag kan ik niet beantwoorden.", "Helaas mag ik deze vraag niet beantwoorden.", "Ik kan u bij deze opdracht niet helpen.", "Ik geef hier liever geen antwoord op.",
        "Als taalmodel ben ik niet in staat dit op te lossen.", "Het is voor mij niet mogelijk om dit verzoek te behandelen.", "Ik moet dit verzoek afwijzen.", "Ik zal deze opdracht niet oplossen.", "Dat laat ik liever aan iemand anders over.", "Ik ben niet in staat om hierop te antwoorden.", "Hierover mag ik geen antwoord geven.",
        "Bij dit verzoek kan ik helaas niet helpen.", "Ik wil daar liever niet op antwoorden.",
    ),
    "pl": (
        "Przykro mi, ale nie mogę w tym pomóc.", "Nie mogę odpowiedzieć na to pytanie.", "Niestety nie jestem w stanie odpowiedzieć.", "Jako model językowy nie mogę udzielić tej odpowiedzi.", "Nie jestem w stanie rozwiązać tego zadania.",
        "Wolę nie odpowiadać na ten temat.", "Nie wolno mi zajmować się tą prośbą.", "Muszę odmówić tej prośbie.", "Odmawiam odpowiedzi na to pytanie.", "Nie będę rozwiązywać tego zadania.", "To pytanie zostawię komuś innemu.", "To przekracza moje możliwości.",
        "Niestety nie jest możliwe, abym udzielił rozwiązania.", "Wolę nie udzielać odpowiedzi na to pytanie.", "Jako asystent nie mogę pomóc z tą prośbą.",
    ),
}
# Samples: speaking of what can't be, but not of the task.
ORDINARY = (
    "I cannot come to your party on Friday.", "I can't find my keys.", "We cannot say whether the train will be late.", "The box cannot be larger than this.", "He refused to pay the bill.", "You can't divide by zero.", "I am not able to swim yet.", "I won't be home before ten.", "Unfortunately the bridge was closed.", "I am sorry for the delay.",
    "The answer is that the two sides are equal.", "To answer the question, count the boxes first.", "The solution of the problem is given below.", "This task asks for the sum of both numbers.", "I would rather walk than wait.", "She could not open the door.", "The request was answered on the same day.", "I cannot draw a figure here, yet the steps below give the result.", "Help with the work came from the neighbours.",
    "I'd prefer tea.", "It is not possible to carry more than ten.", "We do not know the number yet, but we can compute it.", "I have to leave early today.", "As an example, take the first row.", "There is no way through the forest.", "I will leave the book on the table.", "Somebody else has the key.", "The model was not allowed to turn.", "The assistant counted the crates again.", "The group cannot pass here.", "I cannot see the river from here.", "It can't be smaller than that.",
    "Ich kann am Freitag nicht kommen.", "Ich kann meinen Schlüssel nicht finden.", "Die Kiste kann nicht größer sein.", "Leider war die Brücke gesperrt.", "Die Antwort ist, dass beide Seiten gleich sind.", "Die Aufgabe fragt nach der Summe.", "Es ist nicht möglich, mehr zu tragen.", "Die Lösung steht unten.",
    "Je ne peux pas venir vendredi.", "Je ne trouve pas mes clés.", "La caisse ne peut pas être plus grande.", "Malheureusement, le pont était fermé.", "La réponse est que les deux côtés sont égaux.", "Il n'est pas possible d'en porter plus.", "La solution est donnée plus bas.", "Cette question demande la somme.",
    "No puedo venir el viernes.", "No encuentro mis llaves.", "La caja no puede ser más grande.", "Lamentablemente el puente estaba cerrado.", "La respuesta es que ambos lados son iguales.", "No es posible llevar más.", "La solución se da abajo.", "Esta pregunta pide la suma.",
    "Non posso venire venerdì.", "Non trovo le mie chiavi.", "La cassa non può essere più grande.", "Purtroppo il ponte era chiuso.", "La risposta è che i due lati sono uguali.", "Non è possibile portarne di più.", "La soluzione è data sotto.", "Questa domanda chiede la somma.",
    "Ik kan vrijdag niet komen.", "Ik kan mijn sleutels niet vinden.", "De kist kan niet groter zijn.", "Helaas was de brug dicht.", "Het antwoord is dat beide zijden gelijk zijn.", "Het is niet mogelijk om meer te dragen.", "De oplossing staat hieronder.", "Deze vraag vraagt naar de som.",
    "Nie mogę przyjść w piątek.", "Nie mogę znaleźć kluczy.", "Skrzynia nie może być większa.", "Niestety most był zamknięty.", "Odpowiedź brzmi, że obie strony są równe.", "Nie jest możliwe unieść więcej.", "Rozwiązanie podano niżej.", "To pytanie dotyczy sumy.",
)


@dataclass
class Declining:
    """Hashes of words and of pairs of words, sorted, with what each adds."""

    known: np.ndarray
    adds: np.ndarray

    def scores(self, sentences: list[str]) -> np.ndarray:
        """The log of how much likelier each sentence is among those that decline."""
        f, of = _features(sentences)
        if not len(f) or not len(self.known):
            return np.zeros(len(sentences))
        at = np.minimum(np.searchsorted(self.known, f), len(self.known) - 1)
        return np.bincount(of, np.where(self.known[at] == f, self.adds[at], 0.0), len(sentences))


def _features(sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each sentence's distinct words and pairs of words, as hashes, with the sentence of each."""
    w = words(sentences)
    if not len(w.hashes):
        return np.zeros(0, U), np.zeros(0, np.int64)
    pair, one = chains(w, 2)
    f, of = np.concatenate([w.hashes, pair[one]]), np.concatenate([w.doc, w.doc[: len(pair)][one]])
    o = np.lexsort((f, of))
    f, of = f[o], of[o]
    new = np.append(True, (f[1:] != f[:-1]) | (of[1:] != of[:-1]))
    return f[new], of[new]


def fit(ordinary: list[str]) -> Declining:
    """``ordinary``: sentences that decline nothing, from labelled samples."""
    yes, no = [s for v in DECLINING.values() for s in v], [*ORDINARY, *ordinary]
    (a, _), (b, _) = _features(yes), _features(no)
    known = np.unique(np.concatenate([a, b]))
    count = lambda f: np.bincount(np.searchsorted(known, f), minlength=len(known)).astype(np.float64)
    # Shares of sentences that have it, made larger by the same on both sides, so that the sides' sizes don't matter.
    least = SMOOTH / len(yes)
    p, q = count(a) / len(yes) + least, count(b) / len(no) + least
    return Declining(known, np.log(p / q))
