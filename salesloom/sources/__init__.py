"""Tables in, tables out: scans with declared schemas, literal rows, appends, frozen results."""
