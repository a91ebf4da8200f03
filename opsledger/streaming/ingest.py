"""From raw messages to the event history and the dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame

from opsledger.flights import BRONZE_SCHEMA
from opsledger.operators.contract import FLIGHT_CONTRACT, Contract, contract_counts, split_accepted, to_bronze, validate_events
from opsledger.operators.layout import check_append
from opsledger.sources.streams import each_batch, write_batch

# The history lies in folders by load and by this day, so that reads of some days skip the others.
DAY = "scheduled_date"


def ingest(
    messages: DataFrame, bronze: str, dead_letters: str, checkpoint: str, contract: Contract = FLIGHT_CONTRACT
):
    """A writer that validates every micro-batch and routes each record to exactly one table.

    A batch is judged once and read twice. Both tables are written per batch id, so a batch that is
    run again after a failure replaces its own output.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = validate_events(batch.select("value"), contract).persist()
        try:
            accepted, dead = split_accepted(judged)
            write_batch(check_append(to_bronze(accepted), BRONZE_SCHEMA), bronze, batch_id, by=DAY)
            write_batch(dead, dead_letters, batch_id)
        finally:
            judged.unpersist()

    return each_batch(messages, checkpoint, handle)


def accepted_stream(messages: DataFrame, contract: Contract = FLIGHT_CONTRACT) -> DataFrame:
    """The accepted, typed events of a message stream, for windows that need no history."""
    return split_accepted(validate_events(messages.select("value"), contract))[0]


def running_counts(messages: DataFrame, contract: Contract = FLIGHT_CONTRACT) -> DataFrame:
    """Records consumed, accepted and rejected so far."""
    return contract_counts(validate_events(messages.select("value"), contract))
