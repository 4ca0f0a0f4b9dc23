"""Writers: the date-partitioned lake, audit appends, tables, the ledger."""
