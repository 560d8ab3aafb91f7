"""Files -> client masters: the ingest side of the survey model.

    files (binaryFile) -> long cells with headers -> long answers, Likert per file
                                                  -> columns per client
    -> wide recoded master per client (+ client ids) -> parquet by client

Every arrow is a DataFrame transformation. The decoded cells and the judged
answers are each written once to the checkpoint folder; ``Masters.write`` makes
all masters from them in one pass, ``Masters.client`` one client's as a frame. Only metadata (client names, a client's column list)
comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.operators.profile import likert_by_file
from visitlens.operators.reshape import outer_union, same_types
from visitlens.plans import master as M
from visitlens.plans.one_pass import write_masters
from visitlens.plans.recode import recode_survey
from visitlens.session import ensure_checkpoint_dir
from visitlens.sources import ingest as I


@dataclass
class Masters:
    answers: DataFrame      # long answers (client, venue, file, row, respondent, headers, value, Likert)
    dictionary: DataFrame   # columns per client (client_name, headers, col_ord, ..., unique_name)
    quarantine: DataFrame   # files that could not be decoded (path, error)
    clients: DataFrame      # client dimension (client_id, client_name)
    recode: bool = True

    def named(self) -> DataFrame:
        """Long answers with each client's unique column names."""
        return M.named_answers(self.answers, self.dictionary)

    def client(self, name: str) -> DataFrame:
        """Wide master of one client, with the columns that its files have."""
        wide = M.pivot_client(self.answers, self.dictionary, name).drop("file_id", "row_id")
        if self.recode:
            wide = recode_survey(wide, likert=[])
            numbers = [r["column_name"] for r in M.likert_names(self.answers, self.dictionary)
                       .where(F.col("client_name") == name).collect()]
            wide = wide.withColumns({c: F.col(c).try_cast("double") for c in numbers if c in wide.columns})
        return M.with_client_ids(wide, dimension=self.clients)

    def each(self) -> Iterator[tuple[str, DataFrame]]:
        """(client name, wide master) of every client, in name order."""
        for row in self.clients.orderBy("client_name").select("client_name").toLocalIterator():
            yield row[0], self.client(row[0])

    def write(self, path: str) -> None:
        """Every client's wide master as one snapshot at ``path``, in one pass over
        the answers (``one_pass``); read it back with ``one_pass.read_masters``."""
        write_masters(self, path)

    @property
    def masters(self) -> DataFrame:
        """All clients in one frame; a column a client lacks is null, and one
        whose type differs between clients is text."""
        return outer_union(same_types([df for _, df in self.each()]))


def build_masters(spark: SparkSession, root: str, recode: bool = True, likert: list[str] | None = None,
                  known_clients: DataFrame | None = None, masters: bool = False) -> Masters:
    """Masters of the exports below ``root``; with ``masters`` from the ``..._master``
    files of earlier loads, which name client and venue in their rows.

    ``likert=[]`` leaves Likert answers as they are; by default they are
    judged file by file. ``known_clients`` keeps the ids of an earlier load."""
    ensure_checkpoint_dir(spark)
    # decoding (Python, per file) is the costly step: once, then from the folder
    decoded = I.read_cells(spark, root, masters).checkpoint(eager=True)
    cells, quarantine = I.split_errors(decoded)
    answers = I.answer_cells(cells)
    if recode and likert is None:
        answers = likert_by_file(answers, ["file_id", "col_ord"], name="header")
    else:
        answers = answers.withColumns({"is_likert": F.lit(False), "likert_score": F.lit(None).cast("double")})
    answers = answers.checkpoint(eager=True)
    headers = I.header_cells(cells)
    dictionary = M.client_dictionary(headers).checkpoint(eager=True)
    clients = M.client_dimension(headers.select("client_name"), known=known_clients).checkpoint(eager=True)
    return Masters(answers, dictionary, quarantine, clients, recode)
