"""Sources and sinks: landing CSV scan, feeds derived from tables, stage and
warehouse tables, quarantine output."""
