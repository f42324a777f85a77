"""Vocabularies, stored tables and the pair classifier."""

import uuid

from pyspark.sql import functions as F

from codelake.catalog.base import CODE, TURNS, documents, query, table, text_of, turns
from codelake.catalog.encoding import COMMON
from codelake.functions import arrays as A
from codelake.functions import text as T
from codelake.operators import evaluate, pairs, unigram, vocab
from codelake.plans.pairs import train_and_judge
from codelake.plans.vocabularies import CONFIGURATIONS, learn
from codelake.session import durable, ensure_checkpoint_dir
from codelake.sources import corpus as S
from codelake.sources.generated import generated_code


def fresh_folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def document_words(spark, folder):
    return vocab.word_counts(documents(spark, folder), T.words(F.col("text")))


@query("voc1_word_counts", r"""
select w as word, count(*) as freq from (select unnest(regexp_extract_all(text, '\S+')) as w from documents) group by w""")
def word_counts(spark, folder):
    return vocab.word_counts(documents(spark, folder), T.words_by_space(F.col("text")))


@query("voc2_learn_bpe_chars")
def learn_bpe_chars(spark, folder):
    return vocab.learn_bpe(document_words(spark, folder), 32000, 2, vocab.SPECIALS["bert"]).merge_table(spark)


@query("voc2_first_merge", r"""
with w as (select w, count(*) as n from (select unnest(regexp_extract_all(text, '\w+|[^\w\s]+')) as w from documents) group by w),
p as (select w[i] as l, w[i + 1] as r, n from (select w, n, unnest(range(1, length(w))) as i from w))
select 0::INTEGER as rank, l as "left", r as "right" from p group by l, r order by sum(n) desc, l, r limit 1""")
def first_merge(spark, folder):
    counts = document_words(spark, folder)
    letters = counts.select(F.explode(vocab.initial_symbols(F.col("word"), "chars"))).distinct().count()
    return vocab.learn_bpe(counts, letters + 1).merge_table(spark)


@query("voc2_learn_bpe_bytes")
def learn_bpe_bytes(spark, folder):
    words = T.words_with_space(F.col("text"))
    counts = vocab.word_counts(documents(spark, folder), words)
    return vocab.learn_bpe(counts, 50265, 2, vocab.SPECIALS["roberta"], "bytes", all_bytes=True).merge_table(spark)


@query("voc3_learn_wordpiece")
def learn_wordpiece(spark, folder):
    counts = vocab.word_counts(documents(spark, folder), T.words_punct_digits(F.col("text")))
    return vocab.learn_wordpiece(counts, 32000, 2, vocab.SPECIALS["wordpiece"]).vocab(spark)


@query("voc4_learn_unigram")
def learn_unigram(spark, folder):
    model = unigram.learn_unigram(document_words(spark, folder), 32000, ["<unk>"])
    return unigram.model_table(spark, model)


@query("enc1_encode_bpe")
def encode_bpe(spark, folder):
    texts = documents(spark, folder)
    model = vocab.learn_bpe(document_words(spark, folder), 32000, 2, vocab.SPECIALS["bert"])
    ids = F.flatten(vocab.encode_lists(T.words(F.col("text")), model, unknown=4))
    return texts.select("doc_id", text_of(ids).alias("ids"))


@query("enc7_learned_bytes_round_trip", "select doc_id, text from documents")
def learned_bytes_round_trip(spark, folder):
    texts, words = documents(spark, folder), T.words_with_space(F.col("text"))
    model = vocab.learn_bpe(
        vocab.word_counts(texts, words), 50265, 2, vocab.SPECIALS["roberta"], "bytes", all_bytes=True)
    coded = texts.select("doc_id", vocab.encode_lists(words, model).alias("ids"))
    decoded = vocab.decode_lists(F.col("ids"), model.pieces, "bytes")
    return coded.select("doc_id", F.array_join(decoded, "").alias("text"))


@query("enc7_learned_wordpiece_round_trip", f"""
with {CODE} select submission_id,
 array_to_string(regexp_extract_all(text, '[0-9]|[!-/:-@\\[-`{{-~]|[A-Za-z]+'), ' ') as text from code""")
def learned_wordpiece_round_trip(spark, folder):
    code, words = generated_code(spark, folder), T.words_punct_digits(F.col("text"))
    model = vocab.learn_wordpiece(vocab.word_counts(code, words), 32000, 2, vocab.SPECIALS["wordpiece"])
    coded = code.select("submission_id", vocab.longest_match_lists(words, model.pieces, unknown=0).alias("ids"))
    decoded = vocab.decode_lists(F.col("ids"), model.pieces, "wordpiece")
    return coded.select("submission_id", F.array_join(decoded, " ").alias("text"))


@query("enc7_learned_unigram_round_trip", rf"""
with {CODE} select submission_id,
 array_to_string(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\s]+'), ' ') as text from code""")
def learned_unigram_round_trip(spark, folder):
    code, words, specials = generated_code(spark, folder), T.words(F.col("text")), ["<pad>", "<unk>"]
    model = unigram.learn_unigram(vocab.word_counts(code, words), 32000, specials)
    ids = unigram.unigram_lists(words, model, specials, unknown=1)
    decoded = vocab.decode_lists(ids, [piece for piece, _ in model], "chars")
    return code.select("submission_id", F.array_join(decoded, " ").alias("text"))


# Whole texts on either side of the separator, so that both come back.
@query("enc2_learned_pairs", f"""
with {TURNS} select pair_id, code1, code2 from turns""")
def learned_pairs(spark, folder):
    said = turns(spark, folder)
    words = {side: T.words_with_space(F.col(side)) for side in ("code1", "code2")}
    counts = vocab.word_counts(said, F.concat(*words.values()))
    model = vocab.learn_bpe(counts, 50265, 2, vocab.SPECIALS["roberta"], "bytes", all_bytes=True)
    coded = said.select("pair_id", *[F.flatten(vocab.encode_lists(words[side], model)).alias(side) for side in words])
    ids, segments = A.encode_pair("code1", "code2", 2**30, (0, 2))
    laid = coded.select("pair_id", ids.alias("ids"), segments.alias("segments"))
    inner = F.filter(F.arrays_zip("ids", "segments"), lambda x: ~x["ids"].isin(0, 2))

    def side(number):
        part = F.transform(F.filter(inner, lambda x: x["segments"] == number), lambda x: x["ids"])
        return F.array_join(vocab.decode_lists(F.array(part), model.pieces, "bytes"), "")

    return laid.select("pair_id", side(0).alias("code1"), side(1).alias("code2"))


for _name in CONFIGURATIONS:
    @query(f"voc_configuration_{_name}")
    def configured(spark, folder, name=_name):
        return learn(generated_code(spark, folder), "text", name).vocab(spark)


@query("voc5_vocab_report", f"""
with {COMMON}, all_pieces as (select word, id from v union all values ('<pad>', 0), ('<unk>', 1))
select 'size' as item, '' as piece, count(*) as id from all_pieces
union all values ('pad', '<pad>', 0), ('unk', '<unk>', 1), ('mask', '<mask>', 4)
union all (select 'sample', word, id from all_pieces order by id limit 10)""")
def vocab_report(spark, folder):
    counts = vocab.word_counts(generated_code(spark, folder), T.words(F.col("text")))
    words = vocab.word_vocab(counts, ["<pad>", "<unk>"], 1)
    return vocab.vocab_report(words, {"pad": "<pad>", "unk": "<unk>", "mask": "<mask>"})


@query("voc6_extend_vocab", f"""
with {COMMON}, all_pieces as (select word as piece, id::INTEGER as id from v union all values ('<pad>', 0), ('<unk>', 1))
select * from all_pieces union all values ('<mask>', (select max(id) + 1 from all_pieces)), ('<eof>', (select max(id) + 2 from all_pieces))""")
def extend_vocab(spark, folder):
    counts = vocab.word_counts(generated_code(spark, folder), T.words(F.col("text")))
    return vocab.extend_vocab(vocab.word_vocab(counts, ["<pad>", "<unk>"], 1), ["<unk>", "<mask>", "<pad>", "<eof>"])


@query("src9_vocab_round_trip", f"""
with {COMMON} select word as piece, id::INTEGER as id from v union all values ('<pad>', 0), ('<unk>', 1)""")
def vocab_round_trip(spark, folder):
    counts = vocab.word_counts(generated_code(spark, folder), T.words(F.col("text")))
    path = fresh_folder(spark) + ".json"
    S.write_vocab(vocab.word_vocab(counts, ["<pad>", "<unk>"], 1), path)
    return S.read_vocab(spark, path)[0]


@query("src2_pairs_round_trip", "select page_id::VARCHAR as pair_id, html as code1, url as code2 from pages")
def pairs_round_trip(spark, folder):
    path = fresh_folder(spark)
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("pair_id"), F.col("html").alias("Code1_norm"), F.col("url").alias("code2"))
    S.write_pairs(pages, path)
    return S.read_pairs(spark, path, ["pair_id", "code1", "code2"], {"Code1_norm": "code1"})


@query("src4_corpus_round_trip", "select doc_id, lang, text from documents where lang <> 'fr'")
def corpus_round_trip(spark, folder):
    path = fresh_folder(spark)
    S.write_corpus(table(spark, folder, "documents"), path, partition_by=["lang"])
    return S.read_corpus(spark, path, ["doc_id", "lang", "text"], "lang <> 'fr'")


@query("src5_read_or_build", "select doc_id, source from documents where lang = 'en'")
def read_or_build(spark, folder):
    path = fresh_folder(spark)

    def build():
        return table(spark, folder, "documents").where("lang = 'en'").select("doc_id", "source")

    S.read_or_build(spark, path, build)
    return S.read_or_build(spark, path, lambda: build().limit(0))


@query("src6_submission_round_trip", """
select (u.conv_id * 1000 + u.turn) as pair_id, (u.conv_id % 2)::INTEGER as "similar"
from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1
where u.role = 'user' and a.role = 'assistant'""")
def submission_round_trip(spark, folder):
    path = S.write_submission(turns(spark, folder), fresh_folder(spark), "baseline")
    return spark.read.schema("pair_id long, similar int").csv(path, header=True)


def language_pairs(spark, folder):
    """Pairs of documents, similar if of one language, judged on a tenth that the fit has not seen."""
    docs = documents(spark, folder).select(F.col("doc_id").alias("submission_id"), F.col("lang").alias("problem_id"), "text")
    drawn = pairs.attach_code(pairs.build_pairs(docs, "submission_id", 400), docs, "submission_id", "text")
    keyed = drawn.withColumn("pair_id", F.concat_ws("-", "id1", "id2", "similar"))
    return train_and_judge(keyed, "pair_id").validation


@query("scr3_pair_auc")
def pair_auc(spark, folder):
    """The area under the curve of held-out pairs, with their number."""
    scored = durable(language_pairs(spark, folder).select("label", "score"))
    counted = scored.agg(F.count(F.lit(1)).alias("pairs"), F.sum("label").alias("similar"))
    return counted.withColumn("auc", evaluate.roc_auc(scored, "label", "score").scalar())


@query("scr3_score_pairs")
def score_pairs(spark, folder):
    code = generated_code(spark, folder)
    drawn = pairs.attach_code(pairs.build_pairs(code, "submission_id", 100), code, "submission_id", "text")
    keyed = drawn.withColumn("pair_id", F.concat_ws("-", "id1", "id2", "similar"))
    return train_and_judge(keyed, "pair_id").validation.select("pair_id", "label", "score", "similar")
