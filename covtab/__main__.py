from covtab.plans.job import main

main()
