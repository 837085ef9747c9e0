from cabstat.app import main

main()
