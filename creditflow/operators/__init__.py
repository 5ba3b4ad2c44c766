"""One pure ``DataFrame -> DataFrame`` function per stage of the job."""
