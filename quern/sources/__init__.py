from quern.sources.tables import (  # noqa: F401
    TABLES, read_table, as_table, from_elements, generate_sequence,
    read_text_file, connect, kafka_reader_options,
)
