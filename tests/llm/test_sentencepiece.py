import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from scorelake.llm import sentencepiece_codec
from scorelake.llm.queries import TOKENIZERS
from tests.llm.docs import awkward, prose, table

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
ODD = ["", "  a  b ", "\n\nhi\n", "日本語 テスト 🙂 naïve", "    four    spaces\t tab", " lead", "x" * 300, "!!!???...", "<s> </s> <0x0A>", "\x00\x01", "Hello, World! it's 2024."]


def test_bpe_ids_equal_the_library(spark):
    model = sentencepiece_codec.read_model(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ODD + [prose(i, 300) for i in range(20)] + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    codec = sentencepiece_codec.Codec(model)
    found = list(codec.encode(texts))
    assert [f.tolist() for f in found] == library.encode(texts)
    assert [codec.decode(f) for f in found] == texts


def test_unigram_paths_equal_the_library():
    read = proto.ModelProto()
    read.ParseFromString(sentencepiece_codec.read_model(MODEL))
    read.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    for i, piece in enumerate(read.pieces):
        piece.score = -(3.0 + (i * 7919 % 10007) / 1000)  # distinct log probabilities, so paths do not tie
    model = read.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = [prose(i, 60) for i in range(10)] + ["plain english words are cut by their scores"]
    assert [f.tolist() for f in sentencepiece_codec.Codec(model).encode(texts)] == library.encode(texts)


def test_documents(spark):
    docs = table(spark, awkward())
    got = sentencepiece_codec.encode_documents(docs, sentencepiece_codec.read_model(MODEL), "doc_id", "text", "uid").collect()
    assert len(got) == len(awkward()) and all(r.decoded == (r.text or "") for r in got)
    assert all((r.ids == []) == (not r.text) for r in got)
    assert sentencepiece_codec.encode_documents(docs.where(F.lit(False)), sentencepiece_codec.read_model(MODEL), "doc_id").count() == 0
