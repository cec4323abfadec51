"""Training conversations: roles, prompts, image marks, label masks and padding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE, IGNORED = "<image>", -100


def image_first(turn: Column) -> Column:
    """A turn with just one image mark that is not in front gets it moved there, on its own line."""
    once = (F.length(turn) - F.length(F.replace(turn, F.lit(IMAGE), F.lit("")))) == len(IMAGE)
    rest = F.trim(F.replace(turn, F.lit(IMAGE), F.lit("")))
    return F.when(once & ~F.startswith(turn, F.lit(IMAGE)), F.concat(F.lit(IMAGE + "\n"), rest)).otherwise(turn)


def chat_roles(turns: Column, system: str) -> Column:
    """``role, content`` turns: human and gpt renamed, a leading turn that is not the human's dropped, the system's put in front."""
    rename = lambda r: F.when(r == "human", "user").when(r == "gpt", "assistant").otherwise(r)
    named = F.transform(turns, lambda t: F.struct(rename(t["from"]).alias("role"), t["value"].alias("content")))
    first = F.try_element_at(named, F.lit(1))
    body = F.when(first["role"] == "user", named).otherwise(F.slice(named, F.lit(2), F.greatest(F.size(named) - 1, F.lit(0))))
    return F.concat(F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content"))), body)


def prompt(turns: Column) -> Column:
    """Turns as one text with speaker tags."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["content"])), "\n")


def masked_labels(tokens: Column, is_answer: Column) -> Column:
    """Labels of answer tokens; all others are ignored."""
    return F.zip_with(tokens, is_answer, lambda t, a: F.when(a, t.cast("long")).otherwise(F.lit(IGNORED).cast("long")))


def padded(tokens: Column, length: int, pad: int) -> Column:
    """``ids, mask`` cut or filled to a length."""
    cut = F.slice(tokens, 1, length)
    fill = F.greatest(F.lit(length) - F.size(cut), F.lit(0))
    ids = F.concat(cut, F.array_repeat(F.lit(pad).cast("long"), fill))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(cut)), F.array_repeat(F.lit(0), fill))
    return F.struct(ids.alias("ids"), mask.alias("mask"))


def frame_indices(total: Column, wanted: int) -> Column:
    """Evenly spread frame numbers from the first to the last; all if there are no more."""
    some = F.transform(F.sequence(F.lit(0), F.lit(wanted - 1)), lambda i: F.floor(i * (total - 1) / max(wanted - 1, 1)).cast("int"))
    return F.when(total <= wanted, F.sequence(F.lit(0), (total - 1).cast("int"))).otherwise(some)


#: How each form writes the system's text, a human's and a model's turn; ``{}`` is the text.
FORMS = {
    "two_seps": ("{} ", "USER: {} ", "ASSISTANT: {}</s>"),
    "inst": ("<<SYS>>\n{}\n<</SYS>>\n\n", "<s>[INST] {} [/INST]", " {} </s>"),
    "turns": ("", "<start_of_turn>user\n{}<end_of_turn>\n", "<start_of_turn>model\n{}<end_of_turn>\n"),
    "headers": ("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n{}<|eot_id|>", "<|start_header_id|>user<|end_header_id|>\n\n{}<|eot_id|>", "<|start_header_id|>assistant<|end_header_id|>\n\n{}<|eot_id|>"),
    "im_tight": ("<|im_start|>system\n{}<|im_end|>", "<|im_start|>user\n{}<|im_end|>", "<|im_start|>assistant\n{}<|im_end|>"),
    "im_lines": ("<|im_start|>system\n{}<|im_end|>\n", "<|im_start|>user\n{}<|im_end|>\n", "<|im_start|>assistant\n{}<|im_end|>\n"),
    "plain": ("", "{}", "{}\n"),
}


def chat_prompt(turns: Column, form: str, system: str = "") -> Column:
    """``from, value`` turns as the one text that a form makes of them; null where human and model do not alternate.

    A first turn that is not the human's goes.  ``inst`` has its system text within the first human turn and no mark of
    beginning in front; ``plain`` has the image mark alone for a first turn that holds one.
    """
    before, human, model = FORMS[form]
    fill = lambda pattern, text: F.concat(*[x for i, part in enumerate(pattern.split("{}")) for x in ([text] if i else []) + [F.lit(part)]])
    body = F.when(F.try_element_at(turns, F.lit(1))["from"] == "human", turns).otherwise(F.slice(turns, F.lit(2), F.greatest(F.size(turns) - 1, F.lit(0))))
    fair = ~F.exists(F.transform(body, lambda t, i: t["from"] != F.when(i % 2 == 0, "human").otherwise("gpt")), lambda x: x)
    head = F.lit(before.replace("{}", system)) if system and before else F.lit("")
    asked = lambda t, i: F.when(i == 0, F.concat(head, t["value"])).otherwise(t["value"]) if form == "inst" else (F.when((i == 0) & F.contains(t["value"], F.lit(IMAGE)), F.lit(IMAGE)).otherwise(t["value"]) if form == "plain" else t["value"])
    written = F.array_join(F.transform(body, lambda t, i: F.when(i % 2 == 0, fill(human, asked(t, i))).otherwise(fill(model, t["value"]))), "")
    whole = F.regexp_replace(written, "^<s>", "") if form == "inst" else F.concat(head, written)
    return F.when(fair, whole)
