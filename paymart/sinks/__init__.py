"""Writers: day-partitioned tables and topics. Executors write, never the driver."""
